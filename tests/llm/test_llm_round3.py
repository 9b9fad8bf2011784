"""Spelling variants, conversation trie and toxicity grammar against brute force, and their edge cases."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def _near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _vocabulary(seed, letters="abcé", least=6):
    draw = random.Random(seed)
    words = {"".join(draw.choice(letters) for _ in range(draw.randint(least, 9))) for _ in range(150)}
    for word in sorted(words):
        for _ in range(2):
            p, kind = draw.randrange(len(word)), draw.random()
            c = "" if kind < 0.3 else draw.choice(letters)
            words.add(word[:p] + c + word[p + (kind < 0.6):])
    words |= {"a" * 40, "a" * 39, "a" * 41, "a" * 20 + "b" + "a" * 20}
    return {w: draw.choice([5, 5, 6, 30, 200, 1000, 6000]) for w in sorted(words) if len(w) >= least}


@pytest.mark.parametrize("most", [3, 40, 2048])
def test_near_words_agree_with_all_pairs(spark, most):
    from crease.llm.spelling import near_words
    words, want = _vocabulary(most), {}
    for w in words:
        near = [(-words[v], v) for v in words if v != w and _near(w, v)]
        if near:
            want[w] = (len(near), min(near)[1], -min(near)[0])
    got = near_words(spark.createDataFrame(list(words.items()), "word string, n long"), most=most).collect()
    assert {r.word: (r.n_near, r.near, r.near_n) for r in got} == want and len(got) == len(want)


def _words_of(doc, text):
    import re
    for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
        run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
        h = zlib.crc32(f"{doc}:{run}".encode())
        if doc is not None and h % 199 == 0:
            run = run[:h % len(run)] + run[h % len(run) + 1:]
        if len(run) >= 6:
            yield run


def test_variants_follow_their_forms_to_the_last(spark):
    from crease.llm.spelling import variants
    rows = [(k, text, 7, 8) for k, text in enumerate(
        ["Station " * 400, "statione statione STATION " * 12, "ÉTATION étation stationes " * 8, None, "", "éé " * 30,
         "stations " * 60 + "x" * 50_000, "stations " * 60, "stationes"])] + [(None, "Station " * 30, 7, 8), (0, "Station " * 400, 7, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long, word long")
    counts = {}
    for doc, text, *_ in rows:
        for w in _words_of(doc, text):
            counts[w] = counts.get(w, 0) + 1
    counts = {w: n for w, n in counts.items() if n >= 5}
    want = {}
    for w, n in counts.items():
        near = sorted((-counts[v], v) for v in counts if v != w and _near(w, v))
        form = near[0][1] if near and -near[0][0] >= 5 * n else None
        want[w] = [w, form, None, n, len(near), counts[form] if form else None]
    for w in want:
        end = w
        while want[end][1]:
            end = want[end][1]
        want[w][2] = end
    got = variants(docs).collect()
    assert {r.word: list(r) for r in got} == want and len(got) == len(want)
    assert any(v[2] not in (v[0], v[1]) for v in want.values())  # a chain of two forms
    assert variants(docs.limit(0)).count() == 0 and variants(docs.filter("text IS NULL")).count() == 0


def _trie(rows):
    own = {}
    for c, t, r, x, *_ in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    own = {c: [v[2:] for v in sorted(vs)] for c, vs in own.items()}
    paths = {}
    for c, turns in own.items():
        h, first = zlib.crc32(str(c).encode()) % 6, c - int(np.fmod(c, 100))
        paths[c] = tuple(own.get(first, [])[:h] + turns[h:])
    members, kids, leaves, saved = {}, {}, {}, {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    for node in sorted(members, key=len, reverse=True):
        below = kids.get(node, [])
        leaves[node] = sum(leaves[k] for k in below) or 1
        saved[node] = (len(members[node]) - 1) * len(node[-1][1]) * bool(node) + sum(saved[k] for k in below) if node else sum(saved[k] for k in below)
    digest = lambda node: hashlib.sha256(",".join(map(str, sorted(c for c in members[node] if paths[c] == node))).encode()).hexdigest()
    return sorted((min(m), len(node), min(members[node[:-1]]) if node else -1, len(m), len(kids.get(node, [])), leaves[node], saved[node],
                   digest(node)) for node, m in members.items())


def _turns():
    draw, rows = random.Random(5), []
    for c in [*range(40), *range(100, 130), 205, 307, -150, -100, -101]:
        rows += [(c, draw.choice([t, t, None]), draw.choice(["user", None]), draw.choice(["a", "bb", "", None]), 1, 2)
                 for t in range(draw.choice([1, 1, 2, 3, 5, 8]))]
    rows += [(None, 1, "user", "x", 1, 2), (3, 0, "user", "a", 1, 2), (3, 0, "user", "a", 1, 2)]
    rows += [(400, t, "user", f"x{t % 3}", 1, 2) for t in range(60)] + [(401, 0, "user", "long " * 30_000, 1, 2)]
    return rows


@pytest.mark.parametrize("how", [{}, {"hot": 30}, {"base": 12, "split": 3, "piece": 4}])
def test_trie_agrees_with_its_definition(spark, how):
    from crease.llm.convtrie import prefix_trie
    rows = _turns()
    out = prefix_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth long, c long"), **how)
    assert sorted(tuple(-1 if v is None else v for v in r) for r in out.collect()) == _trie(rows)


def test_trie_of_an_empty_table(spark):
    from crease.llm.convtrie import prefix_trie
    assert prefix_trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def _interpreted(symbols):
    """Events by the rules' words, without states: (place, symbol, negated, reported, addressed) and vocatives."""
    from crease.llm import toxicity as T
    out = []
    for i, s in enumerate(symbols):
        clause = max([k for k in range(i) if symbols[k] in (T.SOFT, T.HARD)], default=-1)
        sentence = max([k for k in range(i) if symbols[k] == T.HARD], default=-1)
        if s in (T.STRONG, T.WEAK, T.THREAT):
            near = lambda which, reach: any(symbols[k] in which for k in range(max(clause + 1, i - reach), i))
            tag = near({T.NEGATION}, 3) + 2 * (T.REPORT in symbols[sentence + 1:i]) + 4 * near({T.TARGET}, 4)
            out.append(8 * (s - 1) + tag)
        elif s == T.TARGET and any(symbols[k] in (T.STRONG, T.WEAK, T.THREAT) for k in range(max(clause + 1, i - 3), i)):
            out.append(T.EVENTS - 1)
    return out


def test_composed_transducer_agrees_with_its_rules():
    from crease.llm import toxicity as T
    draw = random.Random(1)
    for _ in range(400):
        symbols, state, got = [draw.choice([0, 0, 0, *range(9)]) for _ in range(30)], 0, []
        for s in symbols:
            state, event = T._ARCS[state][s]
            got += [event] if event >= 0 else []
        assert got == _interpreted(symbols)


def test_clauses_are_scored_not_words(spark):
    from crease.llm import toxicity as T
    texts = ["You are a stupid idiot", "an idiot", "you are not an idiot", "She said that you are an idiot", "I will kill you",
             "to kill a process", "", None, "idiot " * 40_000, "İİ you idiot"]
    docs = spark.createDataFrame([(k, t, 5) for k, t in enumerate(texts)], "doc_id long, text string, score long")
    out = T.score(docs, T.basic())
    assert out.columns == ["doc_id", "text", "score"]
    s = {r.doc_id: r.score for r in out.collect()}
    assert s[0] > s[1] > s[2] > s[6] and s[1] > s[3] and s[4] > s[5] and s[6] == s[7] and s[8] > T.TOXIC
    found = {(r.doc_id, texts[r.doc_id][r.start:r.end], r.event) for r in T.matches(docs.filter("doc_id IN (0, 2, 3, 4, 9)"), T.basic()).collect()}
    assert {(0, "idiot", "strong insult addressed"), (2, "idiot", "strong insult negated addressed"), (4, "you", "addressed after"),
            (3, "idiot", "strong insult reported addressed"), (9, "idiot", "strong insult addressed")} <= found
    assert T.score(docs.limit(0), T.basic()).count() == 0


def test_weights_have_the_least_loss():
    from crease.llm import toxicity as T
    draw = np.random.default_rng(3)
    x, mean = np.append(draw.normal(size=(300, 6)), np.ones((300, 1)), axis=1), np.array([1, 0, -1, 0, 0, 0, 0.0])
    y = (draw.random(300) < T.logistic(x, np.array([2, 0, -1, 1, 0, 0, -1.0]))).astype(float)
    w = T.fit(x, y, mean)

    def loss(v):
        p = T.logistic(x, v)
        return -np.sum(y * np.log(p) + (1 - y) * np.log(1 - p)) + 0.5 * np.sum((v - mean)[:-1] ** 2) + 5e-7 * (v - mean)[-1] ** 2

    for k in range(7):  # finite differences
        e = np.eye(7)[k] * 1e-4
        assert abs(loss(w + e) - loss(w - e)) / 2e-4 < 1e-3
    assert np.allclose(T.fit(x, y[::-1], mean, 1e9)[:-1], mean[:-1], atol=1e-4)


def test_toxicity_learns_words_of_other_languages(spark):
    from crease.llm import toxicity as T
    draw = random.Random(2)
    word = lambda: "".join(draw.choice(["ba", "ko", "mi", "tu", "re"]) for _ in range(3))
    rows, labels = [], []
    for k in range(600):
        toxic = k % 5 == 0
        words = [word() for _ in range(60)]
        for _ in range(3 if toxic else 0):
            words.insert(draw.randrange(len(words)), draw.choice(["grumpf", "zarbol", "grumpfen"]))
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    rows += [(0, rows[0][1])] * 300  # a text copied often is no evidence for each of its words
    labels += [(None, 1), (5, None)]
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = T.train_on(docs, marks)
    learned = {w for w, s in model.words.items() if s in (T.STRONG, T.WEAK)} - set(T.basic().words)
    assert {"grumpf", "zarbol"} <= learned and learned <= {"grumpf", "zarbol", "grumpfen"}
    scored = T.score(docs, model).withColumn("held", T.held_out()).filter("held").distinct().collect()
    assert scored and np.mean([(r.score >= T.TOXIC) == (r.doc_id % 5 == 0) for r in scored]) > 0.97
    assert T.train_on(docs, marks.limit(0)).weights.tolist() == T.prior().tolist()
    assert T.train_on(docs.limit(0), marks).weights.tolist() == T.prior().tolist()


def test_license_chains_are_the_heaviest():
    """Pieces of a template in order, other words between, and a phrase that stands twice in it."""
    from crease.llm.license import TEMPLATES, Automaton, Scanner, words_of
    gpl = [t for label, t in TEMPLATES if label == "gpl"][1]
    words = [w.decode() for w in words_of(gpl.encode())]
    draw = random.Random(4)
    for _ in range(20):
        out, at = [], 0
        while at < len(words):
            size = draw.randint(3, 6) if len(words) - at > 8 else len(words) - at
            out += words[at:at + size] + [f"zz{k}" for k in range(draw.randint(0, 5))]
            at += size
        _, _, spans = Scanner().scan(" ".join(out).encode())
        assert max(s[3] for s in spans if s[0] == "gpl") == 1.0, out
    automaton = Automaton([[1, 2, 3, 4, 5, 1, 2, 3, 6, 7]])
    state = 0
    for token in (1, 2, 3):
        state = automaton.next[state][token]
    assert automaton.ends[state] == {0: {2, 7}}
    scanner = Scanner(phrases=[], templates=[("x", "a b c d e a b c f g")])
    assert scanner.scan(b"a b c f g")[2] == [] and Scanner(phrases=[], templates=[("x", "a b c d e a b c f g")], share=0.5).scan(
        b"a b c f g")[2] == [("x", 0, 5, 0.5)]


def test_license_chains_have_no_cap():
    """A span that still grows while many others of the same template have begun."""
    from crease.llm.license import Scanner
    template = " ".join(f"w{k}" for k in range(60))
    scanner = Scanner(phrases=[], templates=[("x", template)], gap=40)
    words = template.split()
    noise = [" ".join(words[k:k + 3]) for k in range(50, 20, -2)]  # out of order: every one opens a chain of its own
    text = " ".join(words[:20]) + " " + " zz ".join(noise[:9]) + " " + " ".join(words[20:40])
    assert [s for s in scanner.scan(text.encode())[2] if s[3] >= 40 / 60]


def test_license_templates_may_be_a_table(spark):
    from crease.llm.license import report, scan
    table = spark.createDataFrame([("own", "this work may be copied by all who ask"), (None, "x"), ("none", None)], "label string, text string")
    docs = spark.createDataFrame([(1, "This work may be copied, by all who ask."), (2, "nothing of that")], "doc_id long, text string")
    assert {r.doc_id: r.labels for r in report(scan(docs, templates=table)).collect()} == {1: "own", 2: ""}


def test_short_items_are_found_exactly(spark):
    from crease.llm.decontaminate import contained_items, drop_contaminated
    items = spark.createDataFrame([(1, "What is gold?"), (2, "Yes"), (3, "four words stand here"), (4, "..."), (5, None),
                                   (6, "東京の首都")], "doc_id long, text string")
    docs = spark.createDataFrame([(1, "He asked: what is, gold and more"), (2, "what gold is"), (3, "yes"), (4, "four words stand there"),
                                  (5, "x " * 50_000 + "four words stand here"), (6, None), (7, ""), (8, "die 東京の首都 ist")],
                                 "doc_id long, text string")
    found = contained_items(docs, items, item_col="doc_id")
    assert found.columns == ["doc_id", "doc_id_item", "containment"]
    assert sorted(map(tuple, found.collect())) == [(1, 1, 1.0), (3, 2, 1.0), (5, 3, 1.0), (8, 6, 1.0)]
    assert sorted(r.doc_id for r in drop_contaminated(docs, items, item_col="doc_id").collect()) == [2, 4, 6, 7]


def test_one_person_stays_one_person(spark):
    from crease.llm.pii import surrogates
    texts = ["Mr John Smith met Dr John Smith. John Smith left; Smith was tired, SMITH slept. Smithers too.",
             "Sir Arthur Conan Doyle wrote; Doyle's book.", "Mrs O'Brien and Prof O'Brien: O'Brien.", "John Smith without a title",
             "г-жа Анна Петрова и Петрова"]
    docs = spark.createDataFrame([(k, t, 1, 2) for k, t in enumerate(texts)], "doc_id long, text string, __k1 int, n int")
    rows = {r.doc_id: r for r in surrogates(docs, count_col="n").collect()}
    m = __import__("re").fullmatch(r"Mr (\w+) (\w+) met Dr \1 \2\. \1 \2 left; \2 was tired, (\w+) slept\. Smithers too\.", rows[0].text)
    assert m and m[1] != "John" and m[2] != "Smith" and m[3] == m[2].upper() and rows[0].n == 2
    assert not {"Arthur", "Conan", "Doyle", "O'Brien", "Петрова"} & set(" ".join(rows[k].text for k in (1, 2, 4)).replace("'s", "").replace(
        ";", "").replace(".", "").replace(":", "").split()) and rows[1].text.endswith("'s book.")
    assert rows[3].text == texts[3]


def test_further_forms_of_personal_data(spark):
    import re

    from crease.llm.pii import surrogates
    texts = {"phone": "+44 20 7946 0958", "mobile": "07700 900123", "amex": "3782 822463 10005", "ip6": "2001:db8::ff00:42:8329",
             "hub": "ghp_" + "aB3" * 12, "iban": "DE89 3704 0044 0532 0130 00", "pem": "-----BEGIN RSA PRIVATE KEY-----\n" + "MIIEow" * 20 + "\n"}
    kept = ["DE88 3704 0044 0532 0130 00", "12:34:56", "3782 822463 10006", "version 1.2.3", "+1 2", "a::b", "call 0800"]
    rows = [(k, f"see {t} here", None) for k, t in texts.items()] + [(k, f"see {k} here", None) for k in kept]
    got = {r.id: r.body for r in surrogates(spark.createDataFrame(rows, "id string, body string, doc_id int"), "id", "body").collect()}
    shape = lambda s: re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub("[0-9]", "0", s)))
    for k, t in texts.items():
        assert t not in got[k] and (shape(got[k]) == shape(f"see {t} here") or k in ("ip6", "hub", "pem")), (k, got[k])
    assert got["phone"].startswith("see +44 ") and got["hub"].startswith("see ghp_") and re.fullmatch(r"see [0-9a-f:]+ here", got["ip6"])
    digits = got["iban"].replace(" ", "")[3:-4]
    assert int("".join(str(int(c, 36)) for c in digits[4:] + digits[:4])) % 97 == 1
    assert got["pem"].startswith("see -----BEGIN RSA PRIVATE KEY-----\n")
    for k in kept:
        assert got[k] == f"see {k} here"


def test_planted_names_and_numbers_by_brute_force(spark):
    """Every planted value is replaced by one value of its own, in all places; nothing else changes."""
    from crease.llm.pii import surrogates
    draw = random.Random(8)
    names = [f"{a}{b}" for a in ("Bo", "Ka", "Lu", "Ro") for b in ("mir", "tan", "vik", "zel")]
    people = [("Mrs " + draw.choice(names) + " " + draw.choice(names) + "ov") for _ in range(12)]
    plain, texts = "the quick letter went from here to there and 12 more".split(), []
    for _ in range(60):
        texts.append(" , ".join(draw.choice([draw.choice(people), " ".join(draw.sample(plain, 4)), f"{draw.choice('abc')}@x{draw.randint(1, 3)}.org"])
                                for _ in range(6)))
    new = {r.doc_id: r.text for r in surrogates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    seen: dict[str, set] = {}
    for k, t in enumerate(texts):
        old, fresh = t.split(" , "), new[k].split(" , ")
        assert len(old) == len(fresh)
        for a, b in zip(old, fresh):
            seen.setdefault(a, set()).add(b)
    assert all(len(v) == 1 for v in seen.values())
    assert all((a == next(iter(v))) == (not a.startswith("Mrs ") and "@" not in a) for a, v in seen.items())
    assert len({next(iter(v)) for v in seen.values()}) == len(seen)


def test_components_agree_with_a_walk(spark):
    from crease.llm.components import components
    draw = random.Random(7)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(190)] + [(k, k + 1) for k in range(400, 460)] + \
            [(500, k) for k in range(501, 580)] + [(7, 7), (3, 250), (250, 3)] + [(599 - k % 2, 590 + k) for k in range(8)]
    nodes, label = sorted(set(range(300)) | {x for e in edges for x in e} | {900}), {}
    for n in nodes:
        label[n] = n
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    got = components(spark.createDataFrame(edges, "a long, b long"), spark.createDataFrame([(n,) for n in nodes], "id long")).collect()
    assert {r.id: r.lbl for r in got} == label and len(got) == len(nodes)
    none = spark.createDataFrame([], "a long, b long")
    assert components(none, spark.createDataFrame([(1,)], "id long")).collect()[0].lbl == 1
