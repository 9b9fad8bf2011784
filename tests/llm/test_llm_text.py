"""Text operators of the subpackage against brute force, and their edge cases."""

import base64
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def _edge(spark):
    """Nulls in every column, empty, blank, one very long text, ties, repeated rows and clashing extra columns."""
    long = " ".join(f"Wört{i % 977}, the MIT License {i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, "a null id, released under the MIT License"), (None, None),
            (4, "same text here"), (4, "same text here"), (5, "same text here"), (6, long), (7, "a  b\n\n c\x1cd 's 東京 ½ ²³ \U0001F600")]
    return spark.createDataFrame(rows, SCHEMA).select(
        "*", *[F.lit(9).alias(c) for c in ("id", "t", "ids", "n_words", "score", "chunk", "dest", "kind", "row", "size",
                                           "n_tokens", "label", "labels", "node", "slot", "mention", "lens")])


def _empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _tiktoken():
    import public_tokenizers as P
    import tiktoken
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


@pytest.mark.parametrize("source", [_edge, _documents])
def test_bpe_agrees_with_the_library_and_round_trips(spark, source):
    from crease.llm.bpe import decode, digests, encode, token_bytes
    docs, lib = source(spark), _tiktoken()
    texts = [(r[0], r[1] or "") for r in docs.select("doc_id", "text").collect()]
    expected = sorted(((i, lib.encode_ordinary(t)) for i, t in texts), key=repr)
    encoded = encode(docs, chunk_chars=50_000, block_chars=2_000)
    got = sorted(((r.doc_id, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in encoded.collect()), key=repr)
    assert got == expected
    back = sorted(((r.doc_id, bytes(r.decoded).decode()) for r in decode(encoded, token_bytes(spark)).collect()), key=repr)
    assert back == sorted(texts, key=repr)
    row = digests(docs.filter("doc_id = 4" if source is _edge else "doc_id = 0")).first()
    text = dict(texts)[row.doc_id]
    assert row.ids_sha256 == hashlib.sha256(np.array(lib.encode_ordinary(text), "<u4").tobytes()).hexdigest()
    assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_bpe_of_an_empty_table_and_of_an_unknown_id(spark):
    from crease.llm.bpe import decode, digests, token_bytes
    assert digests(_empty(spark)).count() == 0
    bad = spark.createDataFrame([(1, bytearray(np.uint32(999_999).tobytes()))], "doc_id long, ids binary")
    with pytest.raises(Exception, match="not in the token-byte table"):
        decode(bad, token_bytes(spark)).collect()


def test_chunks_do_not_depend_on_their_size(spark):
    from crease.llm.bpe import encode
    docs = _documents(spark)
    rows = [sorted((r.doc_id, bytes(r.ids)) for r in encode(docs, chunk_chars=n, block_chars=m).collect())
            for n, m in ((10_000, 1_000), (10_000_000, 1_000_000))]
    assert rows[0] == rows[1]


def _cheapest(word, costs, byte_cost):
    """Unshared dynamic programming over one word."""
    best = [(0, 0)]
    for end in range(1, len(word) + 1):
        raw = len(word[end - 1].encode())
        options = [(best[end - 1][0] + raw * byte_cost, best[end - 1][1] + raw)]
        options += [(best[s][0] + costs[word[s:end]], best[s][1] + 1) for s in range(end) if word[s:end] in costs]
        best.append(min(options))
    return best[-1][1]


@pytest.mark.parametrize("source", [_edge, _documents])
def test_token_counts_agree_with_unshared_programming(spark, source):
    from crease.llm.tokencount import token_counts, unigram_costs
    costs, byte_cost = unigram_costs()
    known = {}

    def count(word):
        if word not in known:
            known[word] = _cheapest("▁" + word, costs, byte_cost)
        return known[word]

    docs = source(spark)
    expected = sorted(((r[0], len((r[1] or "").split()), sum(map(count, (r[1] or "").split())))
                       for r in docs.select("doc_id", "text").collect()), key=repr)
    assert sorted((tuple(r) for r in token_counts(docs, chunk_chars=40_000).collect()), key=repr) == expected
    assert token_counts(_empty(spark)).count() == 0


def test_trie_counts_of_sorted_words_are_those_of_single_words():
    from crease.llm.tokencount import trie_counts
    draw = random.Random(3)
    costs = {"".join(draw.choice("abc") for _ in range(draw.randint(1, 4))): draw.randint(1, 9) for _ in range(30)}
    words = sorted({"".join(draw.choice("abcd") for _ in range(draw.randint(0, 9))) for _ in range(300)})
    assert trie_counts(words, costs, 5, 4) == [_cheapest(w, costs, 5) for w in words]


_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]


def _base(text):
    words = _WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    found = [(i, label) for phrase, label in _PHRASES for p in [phrase.split()] for i in range(len(words))
             if words[i:i + len(p)] == p]
    starts = [i for i, _ in found]
    return (len(words), len(found), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in found})))


@pytest.mark.parametrize("source", [_edge, _documents])
def test_license_base_places(spark, source):
    from crease.llm.license import report, scan
    docs = source(spark)
    expected = sorted(((r[0], *_base(r[1])) for r in docs.select("doc_id", "text").collect()), key=repr)
    rows = report(scan(docs)).collect()
    assert sorted((tuple(r)[:6] for r in rows), key=repr) == expected
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in rows)
    assert report(scan(_empty(spark))).count() == 0


def test_license_spans(spark):
    from crease.llm.license import Scanner
    scanner = Scanner()
    n, hits, spans = scanner.scan(b"x y Licensed under CC BY-NC 4.0. z")
    assert (n, hits) == (10, []) and [s[:3] for s in spans if s[0] == "cc-by-nc"] == [("cc-by-nc", 2, 9)]
    grant = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
             "documentation FILLER files, to deal in the software without restriction, including without limitation the "
             "rights to use, copy, modify, merge, publish, distribute, sublicense, and or sell copies of the software")
    assert [s[0] for s in scanner.scan(grant.encode())[2]] == ["mit"]
    assert scanner.scan(b"the software is here and you may use it")[2] == []


def test_matching_statistics_are_longest_substrings():
    from crease.llm.license import Automaton
    draw = random.Random(1)
    sequences = [[draw.randint(0, 3) for _ in range(draw.randint(1, 12))] for _ in range(6)]
    pieces = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    automaton, text, state, length = Automaton(sequences), [draw.randint(0, 4) for _ in range(400)], 0, 0
    for at, token in enumerate(text):
        state, length = automaton.step(state, length, token)
        assert length == max((k for k in range(1, at + 2) if tuple(text[at + 1 - k:at + 1]) in pieces), default=0)
        piece = text[at + 1 - length:at + 1]
        if length:
            assert automaton.ends[state] == {k: ends for k, s in enumerate(sequences) for ends in [
                {e for e in range(length - 1, len(s)) if s[e + 1 - length:e + 1] == piece}] if ends}


def _contained(docs, items, n=5, least=0.8):
    def grams(text):
        words = re.findall(r"\w+", (text or "").lower())
        return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}

    sets = [(i, grams(t)) for i, t in items if i is not None or t is not None]
    out = []
    for d, text in docs:
        own = grams(text)
        out += [(d, i, round(len(s & own) / len(s), 9)) for i, s in sets if s and i is not None and len(s & own) / len(s) >= least]
    return sorted(out, key=repr)


def test_decontamination_agrees_with_brute_force(spark):
    from crease.llm.decontaminate import contained_items, drop_contaminated
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    expected = _contained([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert expected
    for size in (20_000, 7):  # one pass or several
        got = [(r[0], r[1], round(r[2], 9)) for r in contained_items(docs, items, slice_items=size).collect()]
        assert sorted(got, key=repr) == expected
    hit = {d for d, _, _ in expected}
    assert {r.doc_id for r in drop_contaminated(docs, items).collect()} == {r.doc_id for r in docs.collect()} - hit


def test_decontamination_edges(spark):
    from crease.llm.decontaminate import contained_items, drop_contaminated
    item = "one two three four five six seven eight nine ten eleven twelve"
    docs = _edge(spark).unionByName(spark.createDataFrame(
        [(20, f"start {item} end"), (20, f"start {item} end"), (None, item.upper()), (21, item.replace("six", "6"))], SCHEMA),
        allowMissingColumns=True)
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (None, item), (3, ""), (4, "too short"), (5, item + " x")],
                                  "item_id long, text string")
    got = sorted(((r[0], r[1]) for r in contained_items(docs, items).collect()), key=repr)
    assert got == sorted([(20, 1), (20, 1), (20, 5), (20, 5), (None, 1), (None, 5)], key=repr)
    assert drop_contaminated(docs, items).count() == docs.count() - 3
    assert drop_contaminated(docs, items).columns == docs.columns
    none = items.limit(0)
    assert contained_items(docs, none).count() == 0 and drop_contaminated(docs, none).count() == docs.count()
    assert contained_items(_empty(spark), items).count() == 0


def test_decontamination_finds_an_item_anywhere_in_a_long_text():
    from crease.llm.decontaminate import Index
    from crease.llm.shingles import shingle_hashes
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(5_000)]
    items = [(k, " ".join(draw.choices(vocabulary, k=draw.randint(12, 70)))) for k in range(60)]
    index = Index(items, 5, 0.8, 0.9995)
    texts = []
    for k, item in items:
        words = item.split()
        words[len(words) // 2] = words[len(words) // 2] if len(words) < 40 else "changed"
        text = draw.choices(vocabulary, k=3_000)
        at = draw.randint(0, 3_000)
        texts.append(" ".join(text[:at] + words + text[at:]))
    found = {(d, i) for d, i, _ in index.search([shingle_hashes(t) for t in texts])}
    assert len(found & {(k, k) for k in range(60)}) >= 59


PAGE = ("<html><head><title>T</title><script>var a='<p>no</p>';</script></head><body>{above}"
        "<{body}><h1>Head &amp; line</h1><p>First <b>bold\n text</b>&nbsp;&eacute; &#8212; more words here.<p>Second one."
        "{within}<p>Yes.</{close}>{below}")


@pytest.fixture(scope="module")
def field(spark):
    from crease.llm.htmlmain import train_on
    return train_on(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


@pytest.mark.parametrize("body", ["article", "main", "div class='post-content'", "div id='content'", "section class='entry'"])
@pytest.mark.parametrize("above", ["<nav><ul><li><a href='/'>Home</a></li></ul></nav>", "<header><div>Site name</div></header>",
                                   "<div class='cookie-banner'>We use cookies to improve this site. Please accept.</div>", ""])
@pytest.mark.parametrize("below", ["<footer>&copy; 2024 Us</footer>", "<aside class='sidebar'><h3>Read also</h3><p>Another story.</p></aside>",
                                   "<section class='comments'><p>I read the whole text and liked it very much.</p></section>",
                                   "<form><label>Your mail</label><input></form>"])
def test_main_text_of_other_templates(field, body, above, below):
    from crease.llm.htmlmain import main_text
    page = PAGE.format(body=body, close=body.split()[0], above=above, below=below, within="<div class='ad'>Buy it now.</div>")
    assert main_text(page, field) == "Head & line\nFirst bold text é — more words here.\nSecond one.\nYes."


def test_main_text_of_the_tables_pages(spark, field):
    import html as H
    from crease.llm.htmlmain import extract
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = {r.page_id: r for r in extract(pages, field).collect()}
    for page in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", page.html, re.S).group(1)
        parts = [" ".join(H.unescape(re.sub(r"</?b>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:h1|p)>", inner)]
        assert rows[page.page_id].text == "\n".join(filter(None, parts))


def test_main_text_edges(spark, field):
    from crease.llm.htmlmain import blocks, extract, train_on
    rows = [(1, None, None), (2, "u", ""), (3, "u", "no markup at all"), (4, "u", "<p>cut off <a hre"), (4, "u", "<p>cut off <a hre"),
            (None, "u", "<!-- never closed"), (5, "u", "<article><p>" + "word " * 200_000 + "</p></article>"),
            (6, "u", "<script>only</script><style>p{}</style><form><select><option>x</select></form>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("TEXT", F.lit(1)).withColumn("__x", F.lit(2))
    got = extract(pages, field)
    assert got.columns == ["page_id", "url", "__x", "text"]
    texts = [(r.page_id, r.text) for r in got.collect()]
    assert len(texts) == 8 and (1, "") in texts and (2, "") in texts and (None, "") in texts and (6, "") in texts
    assert dict(texts)[5] == ("word " * 200_000).strip()
    assert [b.text for b in blocks("<p>a<b>b</b> c<br>d<ul><li>e</ul>f")] == ["ab c d", "e", "f"]
    empty = pages.limit(0)
    assert extract(empty, train_on(empty)).count() == 0


@pytest.mark.parametrize("part, text", [
    ("<p>One.</p><svg viewBox='0 0 1 1'/><p>Two.</p>", ["One.", "Two."]),
    ("<p>One <svg><path d='M0'/></svg>line <math/>here.</p><p>Two.</p>", ["One line here.", "Two."]),
    ("<p>One.</p><button>Share<p>Two.</p><p>Three.</p>", ["One.", "Two.", "Three."]),
    ("<p>One.</p><button>Share<p>Two.</p><button>Like</button><p>Three.</p>", ["One.", "Two.", "Three."]),
    ("<p>One.</p><select><option>a<option>b<p>Two.</p>", ["One.", "Two."]),
    ("<p>One.</p><object data='x'><p>Two.</p>", ["One.", "Two."]),
    ("<p>One.</p><svg><path d='M0'><p>Two.</p>", ["One.", "Two."]),
    ("<p>As <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds.</p>", ["As x=1 holds."]),
    ("<noscript><p>One.</p></noscript><object><p>Two.</p></object>", ["One.", "Two."]),
    ("<p>One.</p><svg><title>icon</title><text>A b</text><text>C</text></svg><p>Two.</p>", ["One.", "A b C", "Two."]),
    ("<p>One.</p><button><div>Share</div></button><select><option>x</option></select><p>Two.</p>", ["One.", "Two."])])
def test_embedded_and_unclosed_tags_lose_no_text(field, part, text):
    from crease.llm.htmlmain import blocks, main_text
    assert [b.text for b in blocks(f"<article>{part}</article>")] == text
    assert [b.text for b in blocks(f"<article>{part}</article><p>After.</p>")] == [*text, "After."]
    page = PAGE.format(body="article", close="article", above="<nav><a href='/'>Home</a></nav>", below="<footer>Us</footer>",
                       within=part)
    assert set(text) <= set(main_text(page, field).split("\n"))


def test_embedded_tags_are_features():
    from crease.llm.htmlmain import blocks, features
    rows = features(blocks("<article><p>As <math><mi>x</mi></math> is.</p><noscript><p>Yes.</p></noscript><p>No.</p></article>"))
    assert ["in:math" in r for r in rows] == [True, False, False] and ["in:noscript" in r for r in rows] == [False, True, False]
    assert all("own:p" in r for r in rows)


def test_viterbi_is_the_best_path():
    import itertools
    from crease.llm.htmlmain import Field
    draw = random.Random(2)
    field = Field({f"f{i}": (draw.gauss(0, 1), draw.gauss(0, 1)) for i in range(9)},
                  [[draw.gauss(0, 1) for _ in range(2)] for _ in range(2)])
    for _ in range(50):
        rows = [[f"f{draw.randint(0, 9)}" for _ in range(3)] for _ in range(draw.randint(1, 7))]

        def worth(path):
            own = sum(field.weights.get(f, (0, 0))[y] for row, y in zip(rows, path) for f in row)
            return own + sum(field.moves[a][b] for a, b in zip(path, path[1:]))

        assert worth(field.decode(rows)) == pytest.approx(max(map(worth, itertools.product((0, 1), repeat=len(rows)))))


def test_quality_on_held_out_rows(spark):
    from crease.llm.quality import held_out, score, train_on
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = train_on(docs, labels)
    rows = score(docs.select("doc_id", "text"), model).join(labels, "doc_id").filter(held_out()).collect()
    assert len(rows) > 90 and sum((r.score >= 0.5) == (r.quality == 1) for r in rows) >= 0.97 * len(rows)
    kept = score(docs, model, least=0.5)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in score(docs, model).filter("score >= 0.5").collect()}


def test_quality_never_learns_from_held_out_labels(spark):
    from crease.llm.quality import held_out, train_on
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = train_on(docs, labels).p, train_on(docs, turned).p
    assert all(np.array_equal(a[k], b[k]) for k in a)


def test_quality_edges(spark):
    from crease.llm.quality import held_out, score, train_on
    docs = _edge(spark).drop("score")
    labels = spark.createDataFrame([(4, 1), (5, None), (None, 1)], "doc_id long, quality int")
    rows = score(docs.select("doc_id", "text"), train_on(docs, labels)).select("*", held_out().alias("h")).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.h is not None for r in rows)
    assert score(_empty(spark), train_on(_empty(spark), labels.limit(0))).count() == 0


def test_attention_gradient_is_that_of_the_loss():
    """One step of learning lowers the loss of a separable set to near zero."""
    from crease.llm.quality import Words, fit, passages
    texts = ["good plain words in a row " * 30 + ("JUNK!! " * 60 if k % 2 else "more plain words follow here " * 12) for k in range(40)]
    model = fit(texts, [1 - k % 2 for k in range(40)], epochs=30)
    rows, owner = passages(texts, Words())
    scores = model.scores(rows, owner, len(texts))
    assert scores[::2].min() > 0.8 and scores[1::2].max() < 0.2
