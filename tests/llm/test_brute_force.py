"""Operators against plain Python on small tables."""

from __future__ import annotations

import hashlib
import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import decontaminate, html, jaccard, mix, neighbours, ngram_lm, pii, quality, toxicity, urls
from tidemark.llm.dom import Forest, Page
from tidemark.llm.html import op4_html, training_nodes
from tidemark.llm.words import ALNUM, SPACED, each_piece

from .cases import LONG, PLAIN, as_table, document_rows, documents

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, (text or "").translate(LOWER))


@pytest.mark.parametrize("inside, pattern", [(SPACED, r"[^\x20\x09-\x0D]+"), (ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")])
def test_words_are_cut_like_the_pattern(inside, pattern):
    import pyarrow as pa

    texts = [r[1] for r in document_rows()] + ["", None, "é\u00a0x", "A-b\x00c"]
    seen: dict[str, int] = {}
    for size in (1 << 21, 64):
        for low, high, cut in each_piece(pa.array(texts, pa.string()), inside, size):
            for i in range(low, high):
                mine = range(cut.first[i - low], cut.first[i - low + 1])
                assert [cut.string(j) for j in mine] == words(texts[i], pattern)
                for j in mine:
                    assert seen.setdefault(cut.string(j), int(cut.hash[j])) == int(cut.hash[j])
    assert len(set(seen.values())) == len(seen)


# ---- 1 url filters ----------------------------------------------------------

PAGES = "page_id long, url string, html string, host string, tokens string"


def page_rows():
    found = [(1, "HTTP://A.Example.NET/en/x?y=1#z"), (2, "https://example.com/de/1"), (3, "https://x.org/fr/2"), (4, "https://net"),
             (5, "https://net/"), (6, "nothing"), (7, None), (8, "https://example.com:80/de/"), (9, "https://notexample.com/de/"),
             (10, "http://b.example.net/de/"), (10, "http://b.example.net/de/"), (11, "a://b.net/c://d.org/fr/"), (12, "s://h?q#f")]
    found += [(100 + i, f"https://bad{i % 3}.example.net/xx/casino/{i}") for i in range(40)]
    found += [(200 + i, f"https://good{i % 3}.example.net/en/story/{i}") for i in range(40)]
    found += [(300, "https://elsewhere.example.io/casino/7"), (301, "https://elsewhere.example.io/story/7")]
    return [(i, u, "", "clash", "clash") for i, u in found]


def url_brute(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0].translate(LOWER)
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    fits = [(len(h + p), h + p, a) for a, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


def test_listed_rules_and_mined_rules(spark):
    got = urls.judged(spark.createDataFrame(page_rows(), PAGES), support=0.05).collect()
    assert len(got) == len(page_rows())
    for row in got:
        url = {r[0]: r[1] for r in page_rows()}[row["page_id"]]
        host, path, rule, action = url_brute(url)
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule)
        if action:
            assert row["verdict"] == action
    verdict = {r["page_id"]: (r["verdict"], r["mined_rule"]) for r in got}
    assert verdict[300][0] == "block" and "p:casino" in verdict[300][1]
    assert verdict[301][0] == "allow" and verdict[6] == ("allow", None)


def test_mined_rules_are_all_confident_and_frequent(spark):
    pages = spark.createDataFrame(page_rows(), PAGES)
    labelled = urls.parsed(pages).filter(F.size("tokens") > 0).withColumn(
        "label", F.when(F.array_contains("tokens", "p:casino"), urls.BLOCK).otherwise(urls.ALLOW))
    rows = labelled.collect()
    for rule in urls.mined_rules(labelled, 0.05, 0.8).collect():
        held = [r for r in rows if set(rule["tokens"]) <= set(r["tokens"])]
        hits = [r for r in held if r["label"][1:] == rule["action"]]
        assert len(hits) == rule["hits"] and len(hits) >= 0.05 * len(rows)
        assert rule["confidence"] == pytest.approx(len(hits) / len(held)) and rule["confidence"] >= 0.8
    assert urls.judged(pages.limit(0)).count() == 0


def test_rules_count_all_tokens_of_long_urls_and_repeated_rows(spark):
    # thirteen tokens a url; the label follows a pair that is not among the ten tokens of the most differing block rates
    found = []
    for i in range(240):
        label, noise = i % 2, [f"n{j}{'xy'[(i // 2 + j) % 3 == 0] if i % 2 else 'xy'[(i // 2 + j) % 4 != 0]}" for j in range(11)]
        pair = ("a1", "b1") if label and i % 4 == 1 else (("a1", "b2"), ("a2", "b1"))[i // 2 % 2]
        found += [(i, f"https://h/{'/'.join([*noise, *('p' + x for x in pair)])}", "", "", "")] * (3 if i % 5 == 0 else 1)
    labelled = urls.parsed(spark.createDataFrame(found, PAGES)).withColumn(
        "label", F.when(F.col("page_id") % 2 == 1, urls.BLOCK).otherwise(urls.ALLOW))
    rows = labelled.collect()
    rules = {(frozenset(r["tokens"]), r["action"]): r for r in urls.mined_rules(labelled, 0.15, 0.7).collect()}
    for (tokens, action), rule in rules.items():
        held = [r for r in rows if tokens <= set(r["tokens"])]
        hits = [r for r in held if r["label"][1:] == action]
        assert (rule["hits"], rule["confidence"]) == (len(hits), pytest.approx(len(hits) / len(held)))
    single = {t for r in rows for t in r["tokens"]}
    for token in single:
        held = [r for r in rows if token in r["tokens"]]
        for label in (urls.BLOCK, urls.ALLOW):
            hits = sum(r["label"] == label for r in held)
            assert ((frozenset([token]), label[1:]) in rules) == (hits >= 0.15 * len(rows) and hits / len(held) >= 0.7)
    assert (frozenset(["p:pa1", "p:pb1"]), "block") in rules


# ---- 2 decontamination ------------------------------------------------------

def contamination(text, items):
    w = words(text, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    hit, found = set(), set()
    for item, body in items:
        b = words(body, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
        n = min(10, len(b))
        windows = {tuple(b[i:i + n]) for i in range(len(b) - n + 1)} if b else set()
        for s in range(len(w) - n + 1 if n else 0):
            if tuple(w[s:s + n]) in windows:
                hit.update(range(s, s + n))
                found.add(str(item))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def test_decontamination_finds_every_window(spark):
    draw = np.random.default_rng(2)
    vocabulary = [f"v{i}" for i in range(12)]
    items = [(i, " ".join(draw.choice(vocabulary, size=int(n)))) for i, n in enumerate(draw.integers(1, 40, 25))]
    items += [(90, None), (91, ""), (92, "one TWO"), (93, items[20][1]), (94, "!?")]
    rows = document_rows()
    for i in range(40):
        parts = [str(items[int(k)][1]) for k in draw.integers(0, 25, 2)]
        cut = [" ".join(p.split()[int(draw.integers(0, 6)):]) for p in parts]
        rows.append((100 + i, ", ".join([" ".join(draw.choice(vocabulary, size=9)), *cut]).upper(), "en", "a", 0, "", "", ""))
    got = decontaminate.op2_decontaminate(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    expected = {(r[0], *contamination(r[1], items)) for r in rows}
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)
    assert sum(r["n_hit"] > 0 for r in got) > 30
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.op2_decontaminate(documents(spark), empty).filter("contaminated").count() == 0
    assert decontaminate.op2_decontaminate(documents(spark, []), empty).count() == 0
    as_text = documents(spark, rows).withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    texts = decontaminate.op2_decontaminate(as_text, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r["n_hit"], r["doc_id"] or "") for r in texts) == sorted((r["n_hit"], "" if r["doc_id"] is None else f"d{r['doc_id']}") for r in got)


# ---- 3 mix ------------------------------------------------------------------

def test_mix_keeps_to_its_targets(spark):
    rows = [r for r in document_rows() if r[0] != 12] + [(40, "", "en", "only empty texts", 0, "", "", "")] + [(50 + i, "word " * (5 + i % 90), "en", "abc"[i % 3], 0, "", "", "") for i in range(300)]
    got = [r.asDict() for r in mix.mixed(documents(spark, rows)).collect()]
    again = [r.asDict() for r in mix.mixed(documents(spark, rows).repartition(5)).collect()]
    key = lambda r: (str(r["doc_id"]), r["copies"], r["taken"], r["target"])
    assert sorted(map(key, got)) == sorted(map(key, again)) and len(got) == len(rows)
    assert all(r["size"] == len(words(r["text"])) and 0 <= r["taken"] <= 2 * r["size"] for r in got)
    for source in {r["source"] for r in got}:
        own = [r for r in got if r["source"] == source]
        assert {r["source_size"] for r in own} == {sum(r["size"] for r in own)}
        assert own[0]["target"] <= 2 * own[0]["source_size"] + 1e-9
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own)
    total = sum(r["size"] for r in got)
    targets = {r["source"]: r["target"] for r in got}
    assert sum(targets.values()) == pytest.approx(1.5 * total)
    assert mix.mixed(documents(spark, [])).count() == 0


# ---- 4 html -----------------------------------------------------------------

def test_html_blocks_and_decoding():
    page = Page("<p>a  b&amp;&#39;c<br>d<p>e<script>var x='<p>no</p>'</script><ul><li>f<li>g</ul>tail<!-- <p>no --><b>!</b>")
    assert [b[1] for b in page.blocks] == ["a b&'c d", "e", "f", "g", "tail!"]
    for broken in ("", "<", "<p", "<p class='x", "</p></p>", "<!--", "<script>", "text", "<div " * 50, "<p>" * 3000 + "x"):
        Page(broken)
    # a kept node under a dropped one pulls its parent in only if it outweighs it
    # root, p, a block in it, a second block of the root
    forest = Forest([Page("<p>a</p>b")])
    assert forest.parent.tolist() == [-1, 0, 1, 0]
    kept = lambda *logit: forest.decode(np.array(logit)).tolist()
    assert kept(1.0, -2.0, 1.5, 0.5) == [True, False, False, True]
    assert kept(1.0, -1.0, 1.5, -1.0) == [True, True, True, False]
    # an element is not kept without a block in it, nor its block without it
    assert kept(1.0, 2.0, -1.0, -9.0) == [True, True, True, False] and kept(0.1, -1.0, 0.5, -3.0) == [False] * 4
    assert kept(1.0, -1.0, 0.5, -3.0) == [True, True, True, False]
    page = Page("<div><p></p></div>")
    assert not Forest([page, Page("x")]).decode(np.ones(len(page.tag) + 2))[:3].any()


def test_raw_elements_hide_no_more_than_themselves():
    def texts(html):
        return [b[1] for b in Page(html).blocks]

    assert texts('<p>a</p><svg width="1"/><p>b</p>') == ["a", "b"]
    assert texts("<p>a</p><svg/><p>b</p><svg><text>no</text></svg><p>c</p>") == ["a", "b", "c"]
    for tag in ("svg", "noscript", "template"):
        assert texts(f"<p>a</p><{tag}><p>b</p>") == ["a", "b"]
        assert texts(f"<p>a</p><{tag}><p>b</p><{tag} x='>'>no</{tag.upper()} ><p>c</p>") == ["a", "b", "c"]
        assert texts(f"<p>a</p><{tag}>no<{tag}>no</{tag}>no</{tag}><p>b</p>") == ["a", "b"]
    assert texts("<p>İ</p><SCRIPT>no</SCRIPT><p>b</p><Style>no</sTYLE><p>c</p>") == ["İ", "b", "c"]
    assert texts("<script>no</scripts></script >b") == ["b"]
    assert texts("<svg>" * 50_000 + "x") == ["x"]
    assert texts("<div data-x=it's>Hello don't stop</div>") == ["Hello don't stop"] and texts("<a href=foo'bar>link</a>") == ["link"]
    assert texts('<img alt="5" tall">x') == ["x"] and texts("<iframe src=x/>after") == ["after"] and texts('<a title="x>y">z</a>') == ["z"]
    began = time.monotonic()
    for odd in ('<a "', '<a ="', "<a ='", '<svg a="', "<!", '<a =\'"'):
        for end in ("", ">", '">x'):
            Page(odd * (1_000_000 // len(odd)) + end)
    assert time.monotonic() - began < 30


def test_html_main_text(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").limit(60)
    extra = spark.createDataFrame([(-1, "u", None), (-2, "u", ""), (-3, None, "<p>")], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in op4_html(pages.unionByName(extra).withColumn("text", F.lit("clash"))).collect()}
    assert all(got[-i]["text"] == "" and got[-i]["n_chars"] == 0 for i in (1, 2, 3))
    for row in pages.collect():
        body = re.search(r"<article>(.*)</article>", row["html"], re.S)[1]
        page = Page(body)
        assert got[row["page_id"]]["text"] == "\n\n".join(b[1] for b in page.blocks)
    assert op4_html(pages.limit(0)).count() == 0


def test_html_main_text_of_pages_outside_the_sample(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    got = {r["page_id"]: r["text"] for r in op4_html(pages).collect()}
    draw = F.xxhash64("page_id", "url", F.lit(4)).alias("draw")
    learnt = {r["draw"] for r in pages.select(draw).distinct().orderBy("draw").limit(html.SAMPLE).collect()}
    outside = [r for r in pages.select("page_id", "html", draw).collect() if r["draw"] not in learnt]
    wrong = [r["page_id"] for r in outside
             if got[r["page_id"]] != "\n\n".join(b[1] for b in Page(re.search(r"<article>(.*)</article>", r["html"], re.S)[1]).blocks)]
    assert len(outside) == 2250 and len(wrong) <= 4


# ---- 5 personal data --------------------------------------------------------

def base_spans(text):
    t, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((0, m.start(), m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(len(x.lstrip("0")) <= 3 and int(x[-3:]) <= 255 for x in m[0].split(".")):
            out.append((1, m.start(), m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 * (int(c) > 4)) for i, c in enumerate(reversed(d))) % 10 == 0:
            out.append((2, m.start(), m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((3, m.start(), m.end(), "phone"))
    return ",".join(f"{k}:{s}:{e}" for _, s, e, k in sorted(out))


def test_base_spans_and_redaction(spark, tmp_path):
    odd = ["a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "999.1.1.1 1.2.3", "@@a@b..c d@e", "+1 +12 345 6789 0 +", "4111-1111-1111-1111-", "x@y.z@q.w",
           "00000000000000000000001.1.1.1", "5 " * 9, "+49 (0) 30 123456", "9" * 30_000, "a." * 20_000 + "@b.c", "1" * 5000 + ".2.3.4", "٣@a.b"]
    rows = document_rows() + [(500 + i, t, "en", "a", 1, "", "", "") for i, t in enumerate(odd)]
    table = as_table(documents(spark, rows), str(tmp_path / "d"))
    got = pii.op5_pii(table).collect()
    assert len(got) == len(rows)
    texts = {}
    for r in rows:
        texts.setdefault(r[0], r[1])
    for row in got:
        base = base_spans(texts[row["doc_id"]])
        assert row["base_sha256"] == hashlib.sha256(base.encode()).hexdigest(), (row["doc_id"], base[:200], row["spans"][:200])
        assert set(filter(None, base.split(","))) <= set(row["spans"].split(","))
        assert row["n_email"] == base.count("email")
    clean = {r["doc_id"]: r for r in pii.redacted(table).collect()}
    assert clean[13]["text"] == "ÄÖ 😀 [EMAIL] 😀 [IP]" and clean[13]["n_chars"] == len(clean[13]["text"])
    assert clean[1]["text"] == PLAIN and clean[4]["text"] is None and clean[1]["size"] == "clash"
    assert pii.op5_pii(table.limit(0)).count() == 0


def test_trees_add_spans_like_the_base_ones(spark, tmp_path):
    rows = [(i, f"call me, phone +1 (555) 010-{1000 + i} or write x{i}@mail.example.com from 10.0.{i % 200}.9", "en", "a", 1, "", "", "") for i in range(150)]
    rows += [(1000 + i, f"version {i}.1234567.890 and number {10 ** 9 + i} of 300.{i}.1.1, 4111 1111 1111 11{10 + i % 7}", "en", "a", 1, "", "", "") for i in range(150)]
    got = pii.op5_pii(as_table(documents(spark, rows), str(tmp_path / "d"))).collect()
    for row in got:
        assert row["base_sha256"] == hashlib.sha256(base_spans(dict((r[0], r[1]) for r in rows)[row["doc_id"]]).encode()).hexdigest()


def test_written_out_addresses_are_candidates_without_a_digit(spark):
    texts = ["write to john (at) example (dot) org please", "JOHN[AT]example[DOT]org", "look at this"]
    rows = pii.proposed(pii.numbered(documents(spark, [(i, t, "en", "a", 1, "", "", "") for i, t in enumerate(texts)])))
    got = {(r["doc_id"], r["kind"], r["m"]) for r in rows.filter("m IS NOT NULL").collect()}
    assert got == {(0, "email", "john (at) example (dot) org"), (1, "email", "JOHN[AT]example[DOT]org")}


# ---- 6 quality --------------------------------------------------------------

def test_quality_learns_and_takes_any_row(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    views = quality.fitted(docs, labels, F.col("doc_id") % 3 != 0)
    truth = {r["doc_id"]: r["quality"] for r in labels.filter("doc_id % 3 = 0").collect()}
    got = {r["doc_id"]: r["score"] for r in quality.scored(docs, views, ["doc_id"]).collect()}
    assert np.mean([(got[i] >= 0.5) == bool(q) for i, q in truth.items()]) >= 0.9
    odd = documents(spark)
    assert quality.good(odd, labels).columns == odd.columns
    assert quality.op6_quality(odd, labels.limit(0)).filter("predicted = 1").count() == odd.count()
    assert quality.op6_quality(documents(spark, []), labels).count() == 0


def test_training_samples_are_bounded_in_rows(spark, sf_dir, monkeypatch):
    docs, labels, pages = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels", "pages"))
    sizes = []
    co_train = quality.co_train
    monkeypatch.setattr(quality, "co_train", lambda text, page, label: sizes.append(len(label)) or co_train(text, page, label))
    one = docs.limit(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("n")
    quality.fitted(docs, labels)
    quality.fitted(docs.union(one).union(docs), labels)
    assert sizes[0] == sizes[1]
    page = pages.limit(1)
    assert training_nodes(page.union(page).union(page)).count() == training_nodes(page).count()


# ---- 7 language model -------------------------------------------------------

def test_lm_base_scores_and_mixture(spark, tmp_path):
    rows = document_rows() + [(20 + i, f"the cat {i % 5} sat on the mat {i % 7} and the dog ran", "en", "a", 1, "", "", "") for i in range(200)]
    got = ngram_lm.op7_lm(as_table(documents(spark, rows), str(tmp_path / "d"))).collect()
    assert len(got) == len(rows)
    split = lambda i: zlib.crc32(str("null" if i is None else i).encode()) % 7 == 2
    train = Counter(t for r in rows if not split(r[0]) for t in [*words(r[1]), None])
    total, types = sum(train.values()), len(train)
    texts = {r[0]: r[1] for r in rows}
    for row in got:
        tokens = [*words(texts[row["doc_id"]]), None]
        assert (row["held_out"], row["n_tokens"], row["train_tokens"]) == (split(row["doc_id"]), len(tokens), total)
        assert row["n_known"] == sum(t in train for t in tokens)
        assert row["base_score"] == pytest.approx(sum(math.log10((train[t] + 1) / (total + types + 1)) for t in tokens))
    held = [r for r in got if r["held_out"] and r["n_tokens"] < 50]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    none = ngram_lm.lm_scores(as_table(documents(spark), str(tmp_path / "n")), F.lit(True)).collect()
    assert all(r["train_tokens"] == 0 and math.isfinite(r["score"]) for r in none)
    assert ngram_lm.op7_lm(as_table(documents(spark, []), str(tmp_path / "e"))).count() == 0


def test_lm_weights_are_learned_on_all_chunks(spark, tmp_path, monkeypatch):
    rows = [(i, f"a{i % 50} b{i % 7} c", "en", "a", 1, "", "", "") for i in range(4 * ngram_lm.CHUNK_ROWS)]
    seen = []
    weights_from = ngram_lm.weights_from
    monkeypatch.setattr(ngram_lm, "weights_from", lambda cells: seen.append(sum(c["n"] for c in cells)) or weights_from(cells))
    got = ngram_lm.op7_lm(as_table(documents(spark, rows).coalesce(1), str(tmp_path / "d"))).select("train_tokens").first()
    assert seen == [got["train_tokens"]]


# ---- 8 neighbours -----------------------------------------------------------

def test_neighbours_recall_ties_and_odd_vectors(spark):
    draw = np.random.default_rng(8)
    data = {i: draw.normal(size=24).astype(np.float32) for i in range(1, 1200)}
    for i in range(300, 330):
        data[i] = data[300]
    data[100] = data[300]
    rows = [(i, [float(x) for x in v], 0) for i, v in data.items()]
    rows += [(2000, None, 0), (2050, [0.0] * 24, 0), (2100, [float("nan")] * 24, 0), (2101, [None] * 24, 0), (None, rows[0][1], 0), rows[4]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = neighbours.op8_neighbours(frame).collect()
    ids = np.array(sorted(data))
    matrix = np.stack([data[i].astype(float) for i in ids])
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    hit = 0
    for q in range(50, 1200, 50):
        mine = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        near = matrix @ matrix[np.flatnonzero(ids == q)[0]]
        near[ids == q] = -2
        best = ids[np.lexsort((ids, -np.round(near, 12)))[:5]]
        hit += len(set(best) & {r["vec_id"] for r in mine})
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
        assert all(r["score"] == pytest.approx(near[np.flatnonzero(ids == r["vec_id"])[0]], abs=1e-12) for r in mine)
        if q == 100:
            assert [r["vec_id"] for r in mine] == [300, 301, 302, 303, 304]
    assert hit / (5 * 23) >= 0.9 and len(got) == 5 * 23
    assert neighbours.op8_neighbours(frame.limit(0)).count() == 0


def test_neighbours_of_equal_cosine_and_of_ids_with_several_vectors(spark):
    # powers of two times one vector: all cosines are equal, so the smallest ids are nearest
    line = [1.0, 3.0, 0.5, 2.0, 0.25, 1.5, 0.75, 4.0]
    rows = [(1 + 7 * i % 61, [x * 2.0 ** i for x in line]) for i in range(60)]
    # the query and one other id have many near vectors, five more ids lie further off
    far = [0.0, 0.0, 0.0, 0.0, 1.0, -1.0, 0.0, 0.0]
    rows += [(i, [*far[:4], 1.0, -1.0, 0.001 * j, 0.0]) for i in (150, 151) for j in range(12)]
    rows += [(152 + j, [*far[:4], 1.0, -1.0, 0.1 + 0.01 * j, 0.0]) for j in range(5)]
    got = neighbours.op8_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    ids = {q: [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (50, 150)}
    smallest = sorted({i for i, _ in rows if i < 100} - {50})[:5]
    assert ids == {50: smallest, 150: [151, 152, 153, 154, 155]}


# ---- 9 Jaccard join ---------------------------------------------------------

def test_jaccard_components_match_all_pairs(spark, monkeypatch):
    draw = np.random.default_rng(9)
    rows = document_rows()
    bases = [[f"t{int(x)}" for x in draw.integers(0, 400, size=int(n))] for n in draw.integers(5, 130, 8)]
    for i in range(160):
        text = list(bases[i % 8])
        for _ in range(int(draw.integers(0, 4))):
            text[int(draw.integers(len(text)))] = f"e{int(draw.integers(1000))}"
        rows.append((100 + i, " ".join(text), "en", "a", 1, "", "", ""))
    got = jaccard.op9_jaccard(documents(spark, rows)).collect()
    sets = {}
    for r in rows:
        w = words(r[1])
        sets[r[0]] = {tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))} if w else set()
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    keys = [i for i in sets if i is not None and sets[i]]
    for a in keys:
        for b in keys:
            both = len(sets[a] & sets[b])
            if a < b and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    expected = {(i, len(s), find(i) if s and i is not None else i) for i, s in sets.items()}
    assert {tuple(r) for r in got if r["doc_id"] is not None} == {e for e in expected if e[0] is not None}
    kept = jaccard.one_of_each(documents(spark, rows)).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == sorted(e[0] for e in expected if e[0] is not None and e[0] == e[2])
    assert jaccard.op9_jaccard(documents(spark, [])).count() == 0
    # families in many blocks find the same components
    monkeypatch.setattr(jaccard, "GROUP_SHINGLES", 300)
    assert {tuple(r) for r in jaccard.op9_jaccard(documents(spark, rows).repartition(3)).collect()} == {tuple(r) for r in got}


def meets(value, first, like):
    """Whether two linked sets share as many shingles of their prefixes as both must."""
    key, text = jaccard.prefixes(value, first, like)
    least = [jaccard.spare(int(like.least(n))) for n in np.diff(first)]
    return len(set(key[text == 0]) & set(key[text == 1])) >= max(1, *least)


def test_linked_pairs_share_their_prefixes():
    import pyarrow as pa

    draw = np.random.default_rng(4)
    for size in (1, 2, 3, 5, 6, 7, 12, 20, 33, 70, 150, 400):
        for _ in range(20):
            one = [f"a{int(x)}" for x in draw.integers(0, 10**6, size=size + 3)]
            two = list(one)
            for _ in range(int(size * 0.05) + 1):
                two[int(draw.integers(len(two)))] = "zz"
            cut = list(each_piece(pa.array([" ".join(one), " ".join(two)]), SPACED))[0][2]
            value, first = jaccard.shingle_sets(cut)
            a, b = set(value[:first[1]]), set(value[first[1]:])
            if 100 * len(a & b) >= 85 * len(a | b):
                assert meets(value, first, jaccard.CONTRACT)


# ---- 10 toxicity ------------------------------------------------------------

def test_one_of_each_decides_by_text_where_ids_repeat(spark):
    other, third = (" ".join(f"{w}{i}" for i in range(60)) for w in "uv")
    near = PLAIN + " tail"
    rows = [(1, PLAIN), (2, near), (2, other), (2, other), (3, third), (3, " ".join(f"z{i}" for i in range(9))), (None, third + " tail"),
            (None, "alone " + "x " * 9), (None, "alone " + "x " * 9), (4, ""), (4, None), (4, None)]
    got = jaccard.one_of_each(documents(spark, [(i, t, "en", "a", 1, "", "", "") for i, t in rows])).collect()
    key = lambda x: (x[0] or 0, x[1] or "")
    expected = [(1, PLAIN), (2, other), (3, third), rows[5], rows[7], (4, ""), (4, None)]
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=key) == sorted(expected, key=key)


def test_shards_of_the_usual_likeness_hold_every_linked_pair():
    import pyarrow as pa

    draw, linked = np.random.default_rng(5), 0
    for size in (1, 2, 3, 5, 6, 7, 12, 20, 33, 70, 150, 400):
        for _ in range(20):
            one = [f"a{int(x)}" for x in draw.integers(0, 10**6, size=size + 4)]
            two = one + [f"b{i}" for i in range(int(draw.integers(0, size // 4 + 1)))]
            cut = list(each_piece(pa.array([" ".join(one), " ".join(two)]), SPACED))[0][2]
            value, first = jaccard.shingle_sets(cut, jaccard.USUAL)
            a, b = set(value[:first[1]]), set(value[first[1]:])
            if 100 * len(a & b) >= 80 * len(a | b):
                assert meets(value, first, jaccard.USUAL)
                linked += len(a) != len(b)
    assert linked > 50


def test_near_copies_of_five_words_and_four_fifths(spark):
    base = [f"w{i}" for i in range(304)]
    rows = [(1, " ".join(base)), (2, " ".join(base + [f"x{i}" for i in range(60)])), (3, " ".join(base + [f"y{i}" for i in range(90)]))]
    docs = documents(spark, [(i, t, "en", "a", 1, "", "", "") for i, t in rows])
    # 300 of 360 shingles of five words, and of 390
    assert {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(docs, jaccard.USUAL).collect()} == {1: 1, 2: 1, 3: 3}
    assert {r["doc_id"]: r["component_id"] for r in jaccard.op9_jaccard(docs).collect()} == {1: 1, 2: 2, 3: 3}
    kept = corpus_pipeline.jaccard_join(spark, docs, "").collect()
    assert sorted(r["doc_id"] for r in kept) == [1, 3]


def test_marginals_are_those_of_all_paths():
    draw = np.random.default_rng(10)
    score, trans = draw.normal(size=7), draw.normal(size=(2, 2))
    first = np.array([0, 4, 4, 7])
    got, _, _ = toxicity.marginals(score, first, trans)
    for low, high in ((0, 4), (4, 7)):
        n, total, on = high - low, 0.0, np.zeros(high - low)
        for path in range(1 << n):
            y = [(path >> i) & 1 for i in range(n)]
            weight = math.exp(sum(score[low + i] * y[i] for i in range(n)) + sum(trans[y[i], y[i + 1]] for i in range(n - 1)))
            total, on = total + weight, on + weight * np.array(y)
        assert np.allclose(got[low:high], on / total, atol=1e-8)


def test_toxicity_scores_and_spans(spark):
    rows, draw = document_rows(), np.random.default_rng(10)
    for i in range(300):
        text = [f"w{int(x)}" for x in draw.integers(0, 300, size=12)]
        text[5] = "Grumblefoo" if i % 3 == 0 else "pleasant"
        rows.append((100 + i, "Über " + " ".join(text), "en", "a", 1, "", "", ""))
    labels = spark.createDataFrame([(r[0], 1, int("Grumblefoo" in r[1])) for r in rows[15:]], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.op10_toxicity(documents(spark, rows), labels).collect()}
    for r in rows[15:]:
        assert got[r[0]]["predicted"] == int("Grumblefoo" in r[1])
        if "Grumblefoo" in r[1]:
            assert "Grumblefoo" in [r[1][int(s.split(":")[0]):int(s.split(":")[1])] for s in got[r[0]]["spans"].split(",")]
    assert got[5]["predicted"] == 0 and got[4]["score"] == got[5]["score"] and got[9]["predicted"] == 0
    none = toxicity.op10_toxicity(documents(spark), labels.limit(0)).collect()
    assert all(abs(r["score"] - 0.5) < 1e-9 for r in none) and len(none) == len(document_rows())
    assert toxicity.op10_toxicity(documents(spark, []), labels).count() == 0


def test_long_text_is_read_whole(spark):
    rows = [(1, LONG + " alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", "a", 1, "", "", "")]
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa")], "item_id long, text string")
    assert decontaminate.op2_decontaminate(documents(spark, rows), items).first()["n_hit"] == 10
