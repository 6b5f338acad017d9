import os
import random
import re
import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
from sigforge.llm import chroma, common, components, decontaminate, html_text, licenses, line_dedup, minhash, mixing, registry, shingles, suffix_dedup, tokens, toxicity  # noqa: E402

#: Columns whose names the operators also use inside.
CLASH = "doc_id long, text string, id long, doc string, words string, sig string, key string, source string, rate string, copies string, size string, line int, _row int, _copies string, _rows string, _text string, _id string, _score string, _spans string, _items string, _n_words string, dropped string, _doc string, _gone string"


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def clashing(spark, rows):
    return frame(spark, [(d, t, 1, "x", "x", "x", "x", None if d is None else f"s{d % 3}", "x", "x", "x", 0, 0, *["x"] * 11) for d, t in rows], CLASH)


def words(rng, n, vocabulary=300):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def near_rows():
    rng = random.Random(1)
    rows = []
    for g in range(12):
        base = words(rng, rng.choice((4, 6, 40, 150)))
        for _ in range(rng.choice((1, 3, 12))):
            t = list(base)
            for _ in range(rng.randrange(5)):
                t[rng.randrange(len(t))] = rng.choice(("zz", "yy", "A"))
            rows.append((len(rows), rng.choice((" ", "\t", "\n")).join(t)))
    return rows + [(900, None), (901, ""), (902, " \n"), (903, "One"), (904, "one"), (905, "word " * 30_000), (906, "WORD " * 30_000)]


@pytest.mark.parametrize("small,largest", [(4096, 16384), (3, 16384), (4096, 5)])
def test_minhash_equals_brute_force(spark, near_rows, monkeypatch, small, largest):
    monkeypatch.setattr(minhash, "SMALL", small)
    monkeypatch.setattr(minhash, "LARGEST_PART", largest)
    got = {r[0]: tuple(r[1:]) for r in minhash.near_duplicates(clashing(spark, near_rows), width=2).collect()}
    assert got == brute.components(dict(near_rows), 2)


def test_minhash_compares_large_buckets_in_few_turns(spark, monkeypatch):
    """Most variants of a text are linked, some with no other; leaders, a few a turn, would need a turn for every few nodes of a large bucket."""
    rng, turns = random.Random(5), []
    base, rows = [f"v{k}" for k in range(80)], []
    for k in range(240):
        t = list(base)
        for at in rng.sample(range(80), 7 if k % 4 == 0 else rng.randrange(1, 4)):
            t[at] = f"x{k}y{at}"
        rows.append((k, " ".join(t)))
    leaders = minhash._leaders
    monkeypatch.setattr(minhash, "_leaders", lambda members, turn: turns.append(turn) or leaders(members, turn))
    monkeypatch.setattr(minhash, "SMALL", 4)
    got = {r[0]: tuple(r[1:]) for r in minhash.near_duplicates(frame(spark, rows), width=2).collect()}
    want = brute.components(dict(rows), 2)
    assert got == want and 2 < sum(x[2] for x in want.values()) < 200
    assert len(turns) <= 4


def test_minhash_nulls_repeats_empty(spark):
    rows = [(1, "a b c"), (1, "a b c"), (None, "a b c"), (None, "x y"), (2, "a b c")]
    got = sorted(map(str, minhash.near_duplicates(frame(spark, rows)).select("doc_id", "component_id", "kept").collect()))
    assert len(got) == 5 and sum("kept=True" in x for x in got) == 2 and any("doc_id=2, component_id=1, kept=False" in x for x in got)
    assert minhash.near_duplicates(frame(spark, [])).collect() == []
    assert sorted(r.doc_id for r in minhash.remove(clashing(spark, [(1, "a b c"), (5, "a b c"), (6, "q")])).collect()) == [1, 6]


def test_word_hashes_of_long_texts_in_little_memory(monkeypatch):
    rng = random.Random(3)
    data = b" ".join([*(b"w%d" % rng.randrange(10**6) for _ in range(400_000)), b"x" * 300_000, b"y"])
    monkeypatch.setattr(shingles, "_tables", {})
    hashes, start = shingles.word_hashes(data)
    assert sum(t.nbytes for t in shingles._tables.values()) <= 16 << 20  # not by the text's length
    assert start.tolist() == [m.start() for m in re.finditer(rb"\S+", data)]
    for block in (1, 7, 1 << 30):
        monkeypatch.setattr(shingles, "BLOCK", block)
        part = data[:20_000]
        h, s = shingles.word_hashes(part)
        assert (h[:-1] == hashes[: len(h) - 1]).all() and (s == start[: len(s)]).all()
    for empty in (b"", b" \n"):
        assert [len(x) for x in shingles.word_hashes(empty)] == [0, 0]


def test_tables_without_checksum_files_notice_damage(spark):
    df = common.materialize(spark.range(20_000).selectExpr("id", "uuid() AS text").repartition(1), "plain")
    folder = Path(df._sigforge_path.removeprefix("file:"))
    assert not list(folder.rglob("*.crc")) and df.count() == 20_000
    (file,) = folder.glob("part-*")
    data = bytearray(file.read_bytes())
    data[len(data) // 2] ^= 1
    file.write_bytes(data)
    with pytest.raises(Exception, match="(?i)crc|checksum"):
        df.agg(F.sum(F.xxhash64("id", "text").cast("decimal(38,0)"))).collect()


def test_workers_forget_the_cache_of_earlier_passes(spark):
    def held(batches):
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([os.getpid()]), pa.array([len(common.kept)])], names=["pid", "n"])

    spec = Path(public_tokenizers.path("word_bpe_49k.json")).read_text(encoding="utf-8")
    docs = frame(spark, [(k, f"some words {k}") for k in range(40)]).repartition(8)
    tokens.tokenize(docs, spec, "doc_id", "text", 1)
    assert any(r.n for r in docs.mapInArrow(held, "pid long, n long").collect())  # for the pass's next tasks
    seen = common.in_arrow(docs, held, "pid long, n long").collect()
    assert seen and not any(r.n for r in seen)


def test_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(30)] + [(5, 5), (None, 3)]
    got = {r.node: r.root for r in components.components(frame(spark, edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in root if find(x) != x}
    assert components.components(frame(spark, [], "a long, b long")).collect() == []


def test_decontamination(spark):
    rng = random.Random(3)
    items = [(k, " ".join(words(rng, n, 40))) for k, n in enumerate((1, 2, 12, 13, 14, 40))] + [(50, None), (51, ""), (52, "w1, W2!"), (2, "only two")]
    docs = [(k, " ".join(words(rng, 60, 40))) for k in range(20)] + [(30 + k, " ".join(words(rng, 30, 40)) + ". " + (t or "").upper() + "\n" + " ".join(words(rng, 30, 40))) for k, (_, t) in enumerate(items)] + [(90, None), (91, ""), (92, "..."), (93, "w3 " * 20_000)]
    expected = brute.contamination(docs, items)
    benchmark = frame(spark, items, "item_id long, text string")
    for block in (decontaminate.BLOCK_BYTES, 200):
        got = {r[0]: tuple(r[1:]) for r in decontaminate.score(clashing(spark, docs), benchmark, block_bytes=block).collect()}
        assert got == expected
    kept = {r.doc_id for r in decontaminate.remove(clashing(spark, docs), benchmark).collect()}
    assert kept == {d for d, x in expected.items() if not x[4]}
    assert {r.contaminated for r in decontaminate.score(frame(spark, docs[:3]), benchmark.limit(0)).collect()} == {False}
    assert decontaminate.score(frame(spark, []), benchmark).collect() == []
    longest = {(r.doc_id, r.item_id): r.n_words for r in decontaminate.longest_matches(frame(spark, docs), benchmark).collect()}
    assert longest[35, "5"] == 40


def test_decontamination_keeps_equal_ids_apart(spark):
    long_ = " ".join(f"q{k}" for k in range(20))
    got = decontaminate.score(frame(spark, [(1, long_), (1, "x"), (None, long_)]), frame(spark, [(1, long_)], "item_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.contaminated) for r in got) == [(0, True), (1, False), (1, True)]


@pytest.mark.parametrize("most,colliding", [(20_000, False), (3, False), (1, False), (20_000, True)])
def test_suffix_dedup_equals_brute_force(spark, monkeypatch, most, colliding):
    monkeypatch.setattr(suffix_dedup, "_SEGMENT", 64)
    if colliding:  # the first hash names nothing
        monkeypatch.setattr(suffix_dedup, "_class_hash", lambda x, seed: x if seed else x & np.uint64(1))
    rng = random.Random(4)
    docs = [(k, "".join(rng.choice("ab") for _ in range(rng.randrange(90)))) for k in range(40)] + [(40, "a" * 300), (41, None), (42, "ab" * 90), (43, "é" * 30), (44, ""), (45, "xé" * 9)]
    expected = brute.repeats(docs, 12)
    got = {r.doc_id: r for r in suffix_dedup.dedup(clashing(spark, docs), length=12, gram=4, most_classes=most).collect()}
    for (d, _), (n, gone, kept) in zip(docs, expected, strict=True):
        r = got[d]
        assert (r.n_bytes, sum(r.spans[1::2]) - sum(r.spans[::2]), bytes(r.kept)) == (n, gone, kept)


def test_suffix_dedup_repeated_rows(spark):
    got = suffix_dedup.dedup(frame(spark, [(1, "x" + "abcdefghij" * 30), (1, "x" + "abcdefghij" * 30), (None, "short"), (None, "short")])).collect()
    assert sorted((r.doc_id or 0, bytes(r.kept)) for r in got) == [(0, b"short")] * 2 + [(1, b"")] * 2  # each "x..." string starts in both rows
    assert suffix_dedup.dedup(frame(spark, [])).collect() == []


def test_suffix_sort():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 99, 400).astype(np.uint8)
    start = np.arange(300)
    size = np.minimum(60, 400 - start)
    order, common = suffix_dedup.sorted_suffixes(data, start, size, np.zeros(300, np.int64))
    texts = [data[s : s + n].tobytes() for s, n in zip(start, size, strict=True)]
    assert [texts[k] for k in order] == sorted(texts)
    for i in range(1, 300):
        x, y = texts[order[i - 1]], texts[order[i]]
        assert common[i] == next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(6)
    base = [words(rng, rng.choice((1, 3, 5, 6, 9)), 8) for _ in range(12)]
    docs = []
    for d in range(30):
        lines = []
        for _ in range(rng.randrange(8)):
            x = list(rng.choice(base))
            kind = rng.randrange(5)
            if kind == 1:
                x[rng.randrange(len(x))] = "new"
            elif kind == 2:
                x.insert(rng.randrange(len(x) + 1), "in")
            elif kind == 3 and len(x) > 1:
                del x[rng.randrange(len(x))]
            lines.append(rng.choice((" ", "\t ")).join(x))
        docs.append((d, "\n".join(lines)))
    docs += [(100, None), (101, ""), (102, "\n \n"), (103, "z " * 3000), (104, "z " * 2999)]
    docs += [(105, "Page 3 of 10\nPage 4 of 10\nPage 41 of 10\nPage 41 of 1"), (106, "abc\nabd"), (107, "東京都千代田区丸の内一\n東京都千代田区丸の内二"), (108, "𝒳" * 8 + "\n" + "𝒳" * 7 + "\n" + "𝒳" * 9)]
    got = {r.doc_id: list(r.dropped) for r in line_dedup.find(clashing(spark, docs)).collect()}
    assert got == brute.line_drops(docs)
    text = {r.doc_id: r.text for r in line_dedup.remove(clashing(spark, docs)).collect()}
    assert all(text[d] == (None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in got[d])) for d, t in docs)


def test_line_dedup_leaves_no_shuffle_files(spark):
    """All that it has written to the cluster's disks by the end are its tables; shuffle files used to wait for the driver's garbage collection."""
    jvm = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {x for x in jvm.getAllFiles().mkString("\n").split("\n") if "shuffle_" in x}
    rng, before = random.Random(8), files()
    rows = [(d, "\n".join(" ".join(words(rng, 6, 4)) for _ in range(5))) for d in range(30)]
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    set_ = spark.conf.get(cleanup, None)
    found = line_dedup.find(frame(spark, rows))
    assert not files() - before and spark.conf.get(cleanup, None) == set_
    assert sum(len(r.dropped) for r in found.collect()) > 30


def test_line_dedup_nulls_and_repeats(spark):
    got = line_dedup.find(frame(spark, [(None, "a b"), (1, "a b\nc"), (1, "a b\nc"), (2, "c")])).collect()
    assert sorted((r.doc_id or 0, list(r.dropped)) for r in got) == [(0, []), (1, [0]), (1, [0, 1]), (2, [0])]  # one of the equal rows is the earliest
    assert line_dedup.find(frame(spark, [])).collect() == []


def test_licenses(spark):
    rows = [
        (1, "Text under CC BY-NC 4.0. All rights\nreserved; all rights reserved"), (2, "GNU General Public License here"), (3, None), (4, ""), (5, "general publicé license cc"), (6, "the " * 20_000 + "Licensed under the Apache License, Version 2.0."),
        (7, "Released under the MIT License."), (None, "cc by"), (7, "cc.by"),
    ]
    got = {(r.doc_id, r.n_words): r for r in licenses.scan(clashing(spark, rows)).collect()}
    x = got[1, 13]
    assert (x.n_base, x.first_word, x.last_word, x.base_labels) == (3, 2, 10, "cc-by,reserved") and {"cc-by", "reserved"} <= set(x.labels.split(","))
    assert (got[2, 5].n_base, got[2, 5].first_word, got[2, 5].labels) == (1, 1, "gpl")
    assert (got[3, 0].n_base, got[3, 0].first_word, got[3, 0].labels, got[3, 0].score) == (0, None, "", 0.0)
    assert got[5, 4].n_base == 0 and "apache-2.0" in got[6, 20_008].labels and got[7, 5].labels == "mit" and got[7, 2].base_labels == got[None, 2].base_labels == "cc-by"
    assert licenses.scan(frame(spark, [])).collect() == []


def test_licenses_equal_brute_force_at_every_position(spark):
    rng = random.Random(3)
    rows = [(k, "x " * k + "Released under the terms of the MIT License" + " y" * 9) for k in range(12)]
    notices = [letters for _, letters in licenses.NOTICES]
    for d in range(100, 300):  # notices stretched and thinned
        text = brute.letters(rng.choice(notices))
        for _ in range(rng.randrange(len(text) + 2)):
            text.insert(rng.randrange(len(text) + 1), rng.choice(("x", "the", "of")))
        if rng.random() < 0.3:
            del text[rng.randrange(len(text))]
        rows.append((d, "x " * rng.randrange(40) + " ".join(text) + " y" * rng.randrange(40)))
    known = [t for t in licenses.templates() if not t.phrase]
    for r in licenses.scan(frame(spark, rows)).collect():
        share, labels = brute.license_shares(dict(rows)[r.doc_id], known), set(filter(None, r.base_labels.split(",")))
        assert set(filter(None, r.labels.split(","))) == labels | {label for label, _ in share}
        assert r.score == pytest.approx(max([s for _, s in share] + [1.0] * (r.n_base > 0), default=0.0))
        assert r.doc_id >= 12 or "mit" in r.labels.split(",")


def test_license_phrases_without_shuffling_the_lists(spark):
    """The lists of template words are a large part of the texts; a join of large tables by row would shuffle them all."""
    rng, phrases = random.Random(6), (("aba", "a b a"), ("ab", "a b"), ("c", "c"))
    rows = [(d, " ".join(rng.choice("abcd") for _ in range(rng.randrange(60)))) for d in range(80)]
    out = licenses.scan(frame(spark, rows), notices=(), phrases=phrases)
    assert "hits" not in out._jdf.queryExecution().executedPlan().toString()
    for r in out.collect():
        w = dict(rows)[r.doc_id].split()
        places = [(i, label) for label, text in phrases for i in range(len(w)) if w[i : i + len(text.split())] == text.split()]
        assert (r.n_base, r.first_word, r.last_word) == (len(places), min(places, default=(None,))[0], max(places, default=(None,))[0])
        assert r.base_labels == r.labels == ",".join(sorted({label for _, label in places}))


def test_toxicity(spark):
    rng = random.Random(7)
    docs = []
    for d in range(400):
        w = words(rng, rng.randrange(20, 120))
        if d % 8 == 0:
            w[rng.randrange(len(w))] = rng.choice(("vile", "nastyab", "nastycd", "nastyef"))
        docs.append((d, " ".join(w)))
    labels = frame(spark, [(d, int(d % 8 == 0)) for d in range(400)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    extra = [(1000, None), (1001, ""), (1002, "w1 w2 V1LE w3"), (1003, "w1 ва viⅼe w3 nastyzz"), (None, "w1 w2"), (1004, "w5 " * 30_000)]
    got = {r.doc_id: r for r in toxicity.score(clashing(spark, docs + extra), labels).collect()}
    assert all(got[d].predicted == (d % 8 == 0) for d in range(400)) and all(0 <= r.score <= 1 for r in got.values())
    assert all(got[d].held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d in range(400))
    assert got[1002].predicted == 1 and got[1003].predicted == 1 and got[1000].score == got[1001].score < 0.5 and got[1004].predicted == 0
    model = toxicity.fit(frame(spark, docs), labels)
    assert {r.doc_id for r in toxicity.remove(clashing(spark, docs), model).collect()} == {d for d in range(400) if d % 8}
    assert toxicity.score(frame(spark, docs[:5]), labels.limit(0)).filter("predicted = 1").count() == 0
    assert toxicity.score(frame(spark, []), labels).collect() == []


def test_toxicity_exceptions_and_folding():
    model = toxicity.Model({" bad": 9.0}, [" badger ", " not bad ", " bad at aii "], -4.0)
    a = model.automaton()
    assert [s > 0.5 for s in model.scores(["bad", "b4d!", "a BADGER ran", "badger bad", "ｂａｄ", "ваd bad", None], a)] == [True, True, False, True, True, True, False]
    assert toxicity.fold("") == toxicity.fold(None) == toxicity.fold(" .. ") == " "
    assert toxicity.fold("SCUM!! a|b, 1!fe | x") == " scum aib iife x "
    assert [s > 0.5 for s in model.scores(["that is not  bad.", "bad, at all", "a bad at one", "not badly"], a)] == [False, False, True, True]
    assert model.scores(["bad " + "x " * 2000], a)[0] < 0.5 < model.scores(["bad x " * 1000], a)[0]  # by length, and each repeat counts
    many = "bad badger " * 40_000
    assert len(toxicity.matches(toxicity.fold(many), a)[0]) == 40_000


def test_toxicity_labels_without_documents(spark):
    docs = frame(spark, [(1, "one two three"), (2, "four five six")])
    labels = frame(spark, [(k, k % 2) for k in range(100, 200)], "doc_id long, toxic int")
    assert [r.predicted for r in toxicity.score(docs, labels).collect()] == [0, 0]


def test_toxicity_learns_exceptions(spark):
    rng = random.Random(8)
    rows = []
    for d in range(600):
        w = words(rng, 30)
        if d % 6 == 0:
            w[5] = w[20] = "vile"
        elif d % 60 == 1:
            w[5:7] = ["vile", "weather"]
        rows.append((d, " ".join(w), int(d % 6 == 0)))
    labels = frame(spark, [(d, y) for d, _, y in rows], "doc_id long, toxic int")
    model = toxicity.fit(frame(spark, [r[:2] for r in rows]), labels)
    a = model.automaton()
    got = model.scores([t for _, t, _ in rows], a)
    assert " viie weather " in model.exceptions and all((s >= 0.5) == y for s, (_, _, y) in zip(got, rows, strict=True))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x="<p>no</p>";</script></head><body><header><h1>Site</h1></header><nav><ul><li><a href=1>Home</a></ul></nav>
<div id="cookie-notice">We use cookies</div><div class="ad">Buy</div><article><h1>Head &amp; tail</h1><p><b>First   words<br>of a longer paragraph that says much.<p>Short.</p><p>Third one, with&nbsp;more text &lt;and&gt; signs.</p></article>
<aside>Other</aside><section class="comments"><p>I think so too, said a reader at great length indeed.</p></section><form><p>Join us</p></form><footer>&copy; me</footer>"""


def test_html(spark):
    rows = [(1, PAGE), (2, None), (3, ""), (4, "plain text"), (5, "<p>only</p><p>two"), (6, "<script>x</script>"), (7, "<article>" + "<p>long text here</p>" * 5000), (1, PAGE)]
    df = spark.createDataFrame([(k, h, "old", 1) for k, h in rows], "page_id long, html string, text string, level int")
    out = html_text.extract(df)
    got = {r.page_id: r.text for r in out.collect()}
    assert got[1] == "Head & tail\nFirst words of a longer paragraph that says much.\nShort.\nThird one, with more text <and> signs."
    assert (got[2], got[3], got[4], got[5], got[6]) == ("", "", "plain text", "only\ntwo", "") and got[7].count("\n") == 4999
    assert set(out.columns) == {"page_id", "html", "text", "level"} and html_text.extract(df.limit(0)).collect() == []


@pytest.mark.parametrize(
    "wrap",
    [
        "<div class='layout has-sidebar'>{}</div>", "<body class=x><div class='no-comments'>{}</div>", "<div class='search-result-page'>{}</div>", "<form>{}</form>", "<head><title>T</title>{}",
        "<head><meta charset=utf-8><body>{}", "<div><button>Go{}</div>", "<noscript>{}", "<div><svg><path d=1>{}</div>", "<body><div class='sidebar'><p>Short.</p></div><div class='search-page'>{}</div>",
    ],
)
@pytest.mark.parametrize("box", ["article", "div"])
def test_html_keeps_wrapped_text(wrap, box):
    said = [f"Sentence {k} of a text that says a good deal about it." for k in range(6)]
    text = html_text.main_text(wrap.format(f"<{box}>" + "".join(f"<p>{x}</p>" for x in said) + f"</{box}>"))
    assert [x for x in text.split("\n") if x.startswith("Sentence")] == said and "Short." not in text


def test_html_keeps_sections_links_and_headings():
    p = "<p>A paragraph that says a good deal about the matter.</p>" * 3
    inside = html_text.main_text(f"<article><div class='post-header'><h1>Head</h1></div>{p}<section id='side-effects'><p>Nausea.</p></section><ul><li><a href=1>Source one</a></ul><div class=comments>{p}</div></article>")
    assert inside.split("\n")[0] == "Head" and "Nausea." in inside and "Source one" in inside and inside.count("A paragraph") == 3
    beside = html_text.main_text(f"<body><nav><a href=1>Home</a></nav><div><h1>Head</h1><div>{p}</div></div><div class=comments>{p * 4}</div><footer>me</footer>")
    assert beside.split("\n")[0] == "Head"
    heavy = html_text.main_text(f"<article>{p}</article><section class=comments>" + f"<article><p>Reader</p>{p}</article>" * 9 + "</section>")
    assert heavy.count("A paragraph") == 3 and "Reader" not in heavy
    replies = "<div class=comments>" + f"<article><p>Reader</p>{p}</article>" * 2 + "</div>"
    assert "Reader" not in html_text.main_text(f"<div>{p}</div>{replies}")


def test_code_round_trip():
    rng = np.random.default_rng(8)
    for n in (0, 1, 2, 3, 4, 5, 1001):
        v = np.where(rng.random(n) < 0.5, rng.integers(0, 300, n), rng.integers(0, 1 << 32, n)).astype(np.uint32)
        control, data = tokens.encode(v)
        assert len(control) == -(-n // 4) and (tokens.decode(control, data, n) == v).all()


def test_token_ids(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["Hello, Wörld's <|endoftext|> 123", None, "", "ΣοφίαΣ İ 漢字 \U0001f44d\U0001f3fd", "  a b c\x1cd \n", "x" * 3000, "word " * 20_000, "é é café"]
    docs = [(10 - k, x) for k, x in enumerate(texts)] + [(4, "again"), (None, "null id")]
    got = tokens.encode_documents(clashing(spark, docs), path=f"file://{tmp_path}/ids", with_ids=True).collect()
    assert len(got) == len(docs) and len(list((tmp_path / "ids").glob("ids-*.bin"))) >= 1
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == start and r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens
    want = sorted((d or 0, t.encode(x or "", add_special_tokens=False).ids + [1]) for d, x in docs)
    assert sorted((r.doc_id or 0, list(r.ids)) for r in got) == want
    assert [r.doc_id or -1 for r in sorted(got, key=lambda r: r.start)] == sorted(d or -1 for d, _ in docs)
    assert tokens.encode_documents(frame(spark, [])).collect() == []


def test_tokenizer_of_other_kind(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    got = tokens.encode_documents(frame(spark, [(1, "Some  text\n here"), (2, "")]), tokenizer=path, end_id=50256, with_ids=True).collect()
    ids = Tokenizer.from_file(path).encode("Some  text\n here", add_special_tokens=False).ids
    assert {r.doc_id: list(r.ids) for r in got} == {1: [*ids, 50256], 2: [50256]}


def test_mixing(spark):
    rng = random.Random(9)
    rows = [(k, " ".join(words(rng, rng.choice((0, 1, 5, 30, 400)))), None if k % 10 == 0 else f"s{k % 4}") for k in range(600)] + [(700, None, "s1"), (701, "", "zero"), (702, "only one", "a"), (702, "only one", "a")]
    df = frame(spark, rows, "doc_id long, text string, source string").withColumn("target", F.lit("x")).withColumn("_bucket", F.lit(1))
    got = mixing.mix(df).collect()
    again = mixing.mix(df.repartition(3)).collect()
    key = lambda r: (r.doc_id, r.source or "", r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again)) and len(got) == len(rows)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    sizes, taken, target = {}, {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert r.size == len(brute.spaced(next(t for d, t, s in rows if (d, s) == (r.doc_id, r.source))))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    goal, full = 1.5 * sum(sizes.values()), set()
    while True:  # what exceeds twice a source's size goes to the others
        level = (goal - sum(2 * sizes[s] for s in full)) / sum(weight[s] for s in order if s not in full)
        more = {s for s in order if s not in full and level * weight[s] > 2 * sizes[s]}
        if not more:
            break
        full |= more
    for s in order:
        assert target[s] == pytest.approx(2 * sizes[s] if s in full else level * weight[s])
        assert abs(taken[s] - target[s]) <= max(3, 0.01 * target[s])
    assert mixing.mix(df.limit(0)).collect() == []


def test_mixing_rates_solve_the_dual(spark):
    rng = random.Random(19)
    rows = [(k, "w " * int(rng.lognormvariate(4, 1.5)), f"s{k % 5 % 3}", rng.choice((0.2, 1.0, 3.0, 0.0, None))) for k in range(3000)]
    df = frame(spark, rows, "doc_id long, text string, source string, base double")
    for column, base in (("base", lambda n, b: b or 0.0), (None, lambda n, b: n / (n + mixing.FRAGMENT))):
        got = mixing.mix(df, base_col=column, share=0.7).collect()
        of = {r[0]: base(len(r[1].split()), r[3]) for r in rows}
        for source in ("s0", "s1", "s2"):
            part = [r for r in got if r.source == source and r.size > 0]
            size, b, target = np.array([r.size for r in part], float), np.array([of[r.doc_id] for r in part]), part[0].target
            lo, hi = -20.0, 20.0
            for _ in range(200):
                mid = (lo + hi) / 2
                lo, hi = (mid, hi) if (size * np.minimum(2, b * np.exp(mid))).sum() < target else (lo, mid)
            rate = np.minimum(2, b * np.exp(lo))
            large = size > 1024  # their rates are those of the whole dual; base rates are in steps of 1/64 of the logarithm
            assert np.allclose(np.array([r.rate for r in part])[large], rate[large], rtol=0.02, atol=1e-9)
            middle = size > 128  # corrected for what rounding missed of the large ones
            assert np.allclose(np.array([r.rate for r in part])[middle], rate[middle], rtol=0.15, atol=1e-9)
            assert abs(sum(r.taken for r in part) - target) <= 0.01 * target and all(abs(r.copies - r.rate) < 1 for r in part)


def test_mixing_repeats_rows_that_share_ids(spark):
    df = clashing(spark, [(None, f"a b {k % 20}") for k in range(40)] + [(7, f"x y {k}") for k in range(40)])
    out = mixing.repeat(df)
    assert out.columns == df.columns and out.count() == pytest.approx(1.5 * 80, abs=3)
    assert out.filter("doc_id = 7").groupBy("text").count().filter("count > 2").isEmpty()


def test_mixing_repeats_documents(spark):
    df = clashing(spark, [(k, "a b c") for k in range(30)])
    out = mixing.repeat(df)
    assert out.columns == df.columns and out.count() == pytest.approx(45, abs=2)
    none = mixing.mix(frame(spark, [(1, "", "s"), (2, None, None)], "doc_id long, text string, source string")).collect()
    assert [(r.taken, r.target) for r in none] == [(0, 0.0)] * 2


def test_chroma(spark):
    rng = np.random.default_rng(10)
    notes = [rng.normal(size=64).tolist() for _ in range(12)]
    media = [(k, chroma.tones(v)) for k, v in enumerate(notes)]
    clear = chroma.samples(media[0][1])
    cut = np.concatenate([rng.normal(0, 200, 6 * chroma.HOP), clear[20 * chroma.HOP :]]) + rng.normal(0, 300, len(clear) - 14 * chroma.HOP)
    media += [(20, chroma.to_wav(cut)), (21, media[1][1]), (22, None), (23, b""), (24, b"noise"), (25, chroma.to_wav(np.zeros(100))), (None, media[1][1]), (26, chroma.to_wav(np.zeros(40_000)))]
    df = spark.createDataFrame([(k, bytearray(m) if m is not None else None, "x") for k, m in media], "vec_id long, media binary, codes string")
    prints = chroma.fingerprint(df, id_col="vec_id", media_col="media")
    for block in (4096, 3):
        got = {r.id: r for r in chroma.search(prints, prints.filter("id < 12"), block).collect()}
        assert got[20].best_query == 0 and got[20].best_offset == -14 and got[20].best_errors < 0.1
        assert got[21].class_id == got[None].class_id == 1 and got[21].best_query == 1 and got[21].best_errors == 0
        assert all(got[k].n_codes == 0 and got[k].n_matches == 0 and got[k].class_id == 22 for k in (22, 23, 24, 25))
        assert [got[k].best_query for k in range(12)] == list(range(12))
    assert chroma.search(prints.limit(0), prints.limit(0)).collect() == []


def test_chroma_aligns_any_overlap():
    rng = np.random.default_rng(12)
    a, b = (rng.integers(0, 1 << 32, 300, dtype=np.uint32) for _ in range(2))
    b[:60] = a[240:]  # the end of one, the start of the other
    assert chroma.Index([a]).align(b) == [(0, -240, 0.0)] and chroma.Index([b]).align(a) == [(0, 240, 0.0)]
    c = rng.integers(0, 1 << 32, 300, dtype=np.uint32)
    c[:60], c[100:170:2] = a[240:], a[100:170:2]  # more equal codes at an offset that fails
    assert chroma.Index([a]).align(c) == [(0, -240, 0.0)]
    d, e = (rng.integers(0, 1 << 32, 300, dtype=np.uint32) for _ in range(2))
    d[280:] = e[:20] = 7
    assert chroma.Index([d]).align(e) == []


def test_registry_and_pipeline(spark, tmp_path):
    import corpus_pipeline

    assert {n.split("_")[0] for n in registry.QUERIES} == {f"op{k}" for k in range(1, 11)}
    rng = random.Random(11)
    passage = " ".join(words(rng, 20))
    texts = [" ".join(words(rng, rng.randrange(40, 90))) for _ in range(200)]
    texts = [t + " vile nasty" if k % 8 == 0 else t for k, t in enumerate(texts)] + [texts[1], texts[1] + " end"] + [f"{texts[2][:60]} {passage}"]
    docs = frame(spark, [(k, t, "en", f"s{k % 3}", len(t)) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    frame(spark, [(k, 1, int(k % 8 == 0)) for k in range(160)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    frame(spark, [(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = {k for k in range(len(texts)) if not (k % 8 == 0 and k < 200)} - {200, 201, 202}
    step = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        step = stage(spark, step, str(tmp_path))
        assert step.columns == docs.columns, name
    assert {r.doc_id for r in step.collect()} == clean
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} <= clean and sum(r.n_tokens for r in out) == max(r.start + r.n_tokens for r in out)
