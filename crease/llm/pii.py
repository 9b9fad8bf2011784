"""Personal data and secrets replaced by surrogates, in DataFrame functions only.

Mentions are found by one pattern.  Every distinct mention is parsed into
entities (type, normal form), every distinct entity gets a surrogate from a keyed
hash, and a collision check goes on until all surrogates of a type differ and
none equals an entity of the corpus.  So equal entities stay equal, however they
are written, and different ones stay different.  A surrogate keeps its type's
shape: digits, letters, separators, and for names the gender that the title tells
and the script.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from crease.llm.common import cut, unused

#: Key of the surrogates; a deployment gives its own and keeps it secret.
KEY = "surrogates"

_TITLES = [("m", "Latin", ["Mr", "Herr", "Señor", "Sr", "Monsieur", "Sir"]),
           ("f", "Latin", ["Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme"]),
           ("n", "Latin", ["Dr", "Prof"]), ("m", "Cyrillic", ["Г-н", "г-н", "Господин", "господин"]),
           ("f", "Cyrillic", ["Г-жа", "г-жа", "Госпожа", "госпожа"])]
_TITLE = "|".join(t for _, _, ts in _TITLES for t in sorted(ts, key=len, reverse=True))
_NAME = r"\p{Lu}[\p{L}'’-]*\p{L}"
_SECRET = r"(?i:password|passwd|pwd|secret|token|api[_-]?key)\"?\s{0,3}[=:]\s{0,3}[\"']?[^\s\"',;]{6,}"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_HEX = "[0-9A-Fa-f]{1,4}"
_PEM = "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"
#: (type, what a text must hold, pattern), in order of precedence.  A pattern first
#: looks at the next letter, which fails fastest almost everywhere.
_RULES = [
    ("pem", ["-----BEGIN"], rf"{_PEM}[A-Za-z0-9+/=\s]{{16,20000}}"),
    ("secret", ["=", ":"], rf"(?=[PpSsTtAa])(?<![\p{{L}}0-9]){_SECRET}"),
    ("key", [], r"(?=[Agsx])(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[opusr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,72}"
                r"|sk-[A-Za-z0-9_-]{20,200})(?![A-Za-z0-9])"),
    ("email", ["@"], r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])"),
    ("ip", ["0-9"], rf"(?=[0-9])(?<![0-9A-Za-z.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9A-Za-z]|\.[0-9])"),
    ("ip6", [":"], rf"(?=[0-9A-Fa-f])(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f:]{{0,39}}[0-9])(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}})(?![0-9A-Za-z:])"),
    ("phone", ["0-9"], r"(?=[+(])(?:(?<![0-9A-Za-z])\+[0-9]{1,3}[ .-]?)?(?<![0-9A-Za-z])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])"),
    ("phone", ["0-9"], r"(?=[+0-9])(?<![0-9A-Za-z.-])(?:\+[0-9]{1,3}[ .-])?[0-9]{3}(?<sep>[.-])[0-9]{3}\k<sep>[0-9]{4}(?![0-9A-Za-z]|[.-][0-9])"),
    ("phone", ["+"], r"(?=\+)(?<![0-9A-Za-z])\+(?=(?:[ .()-]{0,2}[0-9]){8,15}(?![0-9]))[0-9]{1,3}(?:[ .-]?\(?[0-9]{1,4}\)?){2,5}(?![0-9A-Za-z])"),
    ("phone", ["0-9"], r"(?=0)(?<![0-9A-Za-z.,-])0[0-9]{3,4}[ -][0-9]{3}[ -]?[0-9]{3,4}(?![0-9A-Za-z]|[.,-][0-9])"),
    ("ssn", ["0-9"], r"(?=[0-9])(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])"),
    ("card", ["0-9"], r"(?=[0-9])(?<![0-9A-Za-z.-])(?:(?:[0-9]{4}[ -]?){3}[0-9]{4}|3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5})(?![0-9A-Za-z]|[.-][0-9])"),
    ("iban", ["0-9"], r"(?=[A-Z])(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    ("name", [], rf"(?=[DFGHMPSГг])(?<![\p{{L}}0-9])(?:{_TITLE})\.? {_NAME}(?: {_NAME}){{0,2}}"),
]
PATTERNS = [(kind, pattern) for kind, _, pattern in _RULES]
#: All in one: what cuts a text that has some mention.
PATTERN = "|".join(p for _, p in PATTERNS)


def _some(text: Column) -> Column:
    """Whether a text may hold a mention: the patterns one by one, each only where
    the signs that it needs occur.  That is several times faster than their alternation."""
    held = {sign: text.rlike("[0-9]") if sign == "0-9" else text.contains(sign) for _, signs, _ in _RULES for sign in signs}
    by: dict[tuple, list] = {}
    for _, signs, pattern in _RULES:
        by.setdefault(tuple(signs), []).append(text.rlike(pattern))
    tests = [reduce(Column.__or__, found) if not signs else
             reduce(Column.__or__, [held[s] for s in signs]) & reduce(Column.__or__, found) for signs, found in by.items()]
    return F.coalesce(reduce(Column.__or__, tests), F.lit(False))


# Parts of surrogate names, joined at random.
_GIVEN = {("m", "Latin"): (["Ar", "Ben", "Cor", "Dan", "El", "Fab", "Jor", "Mar"], ["an", "ert", "ian", "ino", "rick", "us"]),
          ("f", "Latin"): (["Al", "Bel", "Cor", "Dan", "El", "Fab", "Jul", "Mar"], ["ella", "ia", "ina", "issa", "ora", "ette"]),
          ("n", "Latin"): (["Al", "Cam", "Jor", "Kim", "Mor", "Rob", "Sash", "Tay"], ["ay", "en", "in", "is", "or", "yn"]),
          ("m", "Cyrillic"): (["Ал", "Бор", "Вал", "Ив", "Мак", "Ол"], ["ан", "ей", "ий", "ис", "ор", "ег"]),
          ("f", "Cyrillic"): (["Ал", "Вал", "Ев", "Ир", "Мар", "Ол"], ["ена", "ина", "ия", "ьга", "ата", "ева"])}
_FAMILY = {"Latin": (["Ald", "Brem", "Car", "Dol", "Fen", "Gar", "Hol", "Lind", "Mor", "Wes"],
                     ["ber", "den", "ing", "low", "man", "ner", "ton", "wick"], ["", "er", "field", "sen", "well"]),
           "Cyrillic": (["Бел", "Вол", "Гор", "Кор", "Лап", "Мор", "Сок", "Тих"], ["ан", "ен", "ин", "ол", "ор"],
                        ["ов", "ев", "ин"])}

#: Letters and digits of a secret's further tries.
_FREE = string.ascii_letters + string.digits


def _byte(hexes: Column, i) -> Column:
    """The i-th byte of a 64-byte hash in hex, from 0 on and round again."""
    at = F.pmod(F.lit(i) if isinstance(i, int) else i, F.lit(64)) * 2 + 1
    return F.conv(hexes.substr(at.cast("int"), F.lit(2)), 16, 10).cast("int")


def _pick(words: list[str], byte: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, words)), (byte % len(words) + 1).cast("int"))


def _chars(text: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(text))), lambda i: text.substr(i, F.lit(1)))


def _luhn(digits: Column) -> Column:
    """Sum of a digit string whose last digit is a check digit, modulo ten."""
    def one(c, i):
        d = c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(F.reverse(_chars(digits)), one), F.lit(0), lambda a, x: a + x) % 10


def _mod97(text: Column) -> Column:
    """A string of digits and capital letters (A is 10) as a number modulo 97."""
    return F.aggregate(_chars(text), F.lit(0), lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + c.cast("int")) % 97)
                       .otherwise((a * 100 + F.ascii(c) - 55) % 97))


def _iban_rest(iban: Column) -> Column:
    return iban.substr(F.lit(5), F.length(iban))


def _shape(text: Column, hexes: Column) -> Column:
    """Digits to digits, letters to letters of their case; hexadecimal stays so."""
    span = F.when(text.rlike("^[0-9a-fA-F:]+$"), 6).otherwise(26)

    def one(c, i):
        letter = lambda first: F.chr(F.lit(ord(first)) + _byte(hexes, i) % span)
        return F.when(c.rlike("[0-9]"), (_byte(hexes, i) % 10).cast("string")).when(c.rlike("[a-z]"), letter("a")) \
            .when(c.rlike("[A-Z]"), letter("A")).when(c.rlike(r"\p{Lu}"), F.lit("X")).when(c.rlike(r"\p{L}"), F.lit("x")) \
            .otherwise(c)

    return F.array_join(F.transform(_chars(text), one), "")


def _checked(digits: Column) -> Column:
    """The digits and their check digit."""
    return F.concat(digits, ((F.lit(10) - _luhn(F.concat(digits, F.lit("0")))) % 10).cast("string"))


def _surrogate(kind: Column, normal: Column, key: str, turn: int) -> Column:
    """Candidate of an entity in a round of the collision check."""
    seed = F.concat_ws("\x1f", F.lit(key), kind, normal, F.lit(str(turn)))
    hexes = F.concat(F.sha2(seed, 256), F.sha2(F.concat(seed, F.lit("\x1f")), 256))
    b = lambda i: _byte(hexes, i)
    digits = F.array_join(F.transform(_chars(normal), lambda c, i: F.when(i == 0, b(0) % 9 + 1).otherwise(_byte(hexes, i) % 10)
                                      .cast("string")), "")
    domain = F.substring_index(normal, "@", -1)
    domain_hex = F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("domain"), domain), 512)
    host = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.chr(F.lit(ord("a")) + _byte(domain_hex, i) % 26)), "")
    local = _shape(F.substring_index(normal, "@", 1), hexes)
    more = F.when(F.lit(turn > 0), (b(20) * 256 + b(21)).cast("string")).otherwise("")  # a second try has more room
    out = F.when(kind.isin("phone", "ssn"), digits) \
        .when((kind == "card") & (F.length(normal) == 15), _checked(F.concat(normal.substr(1, 2), digits.substr(3, 12)))) \
        .when(kind == "card", _checked(F.concat(normal.substr(1, 1), digits.substr(F.lit(2), F.length(normal) - 2)))) \
        .when(kind == "ip", F.concat_ws(".", (b(0) % 223 + 1).cast("string"), b(1).cast("string"), b(2).cast("string"),
                                        (b(3) % 254 + 1).cast("string"))) \
        .when(kind == "email", F.concat(local, more, F.lit("@"), host, F.lit(".example"))) \
        .when(kind == "key", F.concat(normal.substr(1, 4), _shape(normal.substr(F.lit(5), F.length(normal)), hexes))) \
        .when(kind == "iban", F.concat(normal.substr(1, 2), F.lpad((98 - _mod97(F.concat(
            _shape(_iban_rest(normal), hexes), normal.substr(1, 2), F.lit("00")))).cast("string"), 2, "0"),
            _shape(_iban_rest(normal), hexes)))
    syllables = ["an", "el", "ir", "on", "ur"]
    cyrillic = ["ан", "ел", "ир", "он", "ур"]
    for (gender, script), (first, last) in _GIVEN.items():
        extra = [_pick(cyrillic if script == "Cyrillic" else syllables, b(8 + t)) for t in range(turn)]
        out = out.when(kind == f"given-{gender}-{script}", F.concat(_pick(first, b(0)), *extra, _pick(last, b(1))))
    for script, (first, mid, last) in _FAMILY.items():
        extra = [_pick(cyrillic if script == "Cyrillic" else syllables, b(8 + t)) for t in range(turn)]
        out = out.when(kind == f"family-{script}", F.concat(_pick(first, b(0)), _pick(mid, b(1)), *extra, _pick(last, b(2))))
    if not turn:
        return out.otherwise(_shape(normal, hexes))
    # signs and letters beyond ASCII leave a shape no room: a further try is letters and digits, longer every round
    free = F.transform(F.sequence(F.lit(1), F.length(normal) + turn), lambda i: F.lit(_FREE).substr(_byte(hexes, i) % 62 + 1, F.lit(1)))
    return out.otherwise(F.array_join(free, ""))


def _parsed(mentions: DataFrame) -> DataFrame:
    """(mention, part, kind, normal): the entities of every mention; a titled name
    has given names and a family name.  A number of a card's or an account's form
    without its check digits is no entity.

    A title such as Dr tells no gender: the given name then has that of the same
    full name elsewhere, else that of the same given name (of both, the male form),
    so that a person keeps one surrogate whatever the title.
    """
    m = F.col("mention")
    kind = reduce(lambda c, p: c.when(m.rlike(f"^(?:{p[1]})$"), p[0]), PATTERNS[2:],
                  F.when(m.rlike(f"^{_PEM}"), "pem").when(m.rlike(f"^(?:{_SECRET})$"), "secret"))
    plain = lambda pattern: F.regexp_replace(m, pattern, "")
    iban = F.regexp_replace(m, " ", "")
    normal = F.when(F.col("kind") == "email", F.lower(m)) \
        .when(F.col("kind") == "phone", F.substring(plain("[^0-9]"), -10, 10)) \
        .when(F.col("kind").isin("ssn", "card"), plain("[^0-9]")) \
        .when(F.col("kind") == "iban", iban) \
        .when(F.col("kind") == "pem", F.regexp_replace(m, f"^{_PEM}", "")) \
        .when(F.col("kind") == "secret", F.regexp_extract(m, r"[=:]\s{0,3}[\"']?([^\s\"',;]+)$", 1)).otherwise(m)
    known = mentions.withColumn("kind", kind) \
        .filter((F.col("kind") != "card") | (_luhn(F.regexp_replace(m, "[^0-9]", "")) == 0)) \
        .filter((F.col("kind") != "iban") | (_mod97(F.concat(_iban_rest(iban), iban.substr(1, 4))) == 1))  # other long numbers stay
    others = known.filter(F.col("kind") != "name").select("mention", F.lit(0).alias("part"), "kind", normal.alias("normal"))
    title = F.regexp_extract(m, rf"^({_TITLE})", 1)
    gender = reduce(lambda c, t: c.when(title.isin(*t[2]), t[0]), _TITLES[1:], F.when(title.isin(*_TITLES[0][2]), _TITLES[0][0]))
    whole = F.regexp_replace(m, rf"^(?:{_TITLE})\.? ", "")
    names = F.split(whole, " ")
    script = F.when(F.col("word").rlike(r"\p{IsCyrillic}"), "Cyrillic").otherwise("Latin")
    parts = known.filter(F.col("kind") == "name").select(
        "mention", gender.alias("gender"), F.lower(whole).alias("whole"), F.size(names).alias("n"), F.posexplode(names).alias("part", "word")) \
        .withColumn("script", script).withColumn("normal", F.lower("word"))
    family = F.col("part") == F.col("n") - 1
    told = parts.filter(~family & F.col("gender").isin("m", "f"))
    one = F.when(F.min("gender") == F.max("gender"), F.min("gender"))
    by_whole = told.groupBy("whole").agg(one.alias("g1"))
    by_form = told.groupBy("script", "normal").agg(F.max("gender").alias("g2"))  # of m and f the m
    settled = parts.join(by_whole, "whole", "left").join(by_form, ["script", "normal"], "left").withColumn("gender", F.when(
        F.col("gender") == "n", F.coalesce("g1", "g2", F.when(F.col("script") == "Cyrillic", "m"), F.lit("n"))).otherwise(F.col("gender")))
    return others.unionAll(settled.select(
        "mention", "part", F.when(family, F.concat(F.lit("family-"), F.col("script")))
        .otherwise(F.concat_ws("-", F.lit("given"), "gender", "script")).alias("kind"), "normal"))


def assign_surrogates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, normal, surrogate) for distinct (kind, normal): within a kind no two
    surrogates agree, and none is an entity of that kind.

    In a round every open entity has a candidate; of equal candidates that are
    not taken the one of the smallest normal form wins, the others go on.  Names,
    mail addresses and secrets have more room every round, so a masked secret
    (``********``) gets letters and digits; numbers keep their length, which has
    room while a corpus holds fewer than about half of all numbers of the type.
    """
    waiting, taken, turn = cut(entities.select("kind", "normal").distinct()), [], 0
    originals = waiting.select("kind", F.lower("normal").alias("form"))
    while True:
        drawn = waiting.withColumn("surrogate", _surrogate(F.col("kind"), F.col("normal"), key, turn)) \
            .withColumn("form", F.lower("surrogate"))
        won = drawn.groupBy("kind", "form").agg(F.min(F.struct("normal", "surrogate")).alias("m")) \
            .join(originals, ["kind", "form"], "left_anti")
        for before in taken:
            won = won.join(before.select("kind", F.lower("surrogate").alias("form")), ["kind", "form"], "left_anti")
        won = cut(won.select("kind", "m.normal", "m.surrogate"))
        taken.append(won)
        waiting = cut(waiting.join(won.select("kind", "normal"), ["kind", "normal"], "left_anti"))
        if waiting.isEmpty():
            return reduce(DataFrame.unionAll, taken)
        turn += 1


def _replacements(mentions: DataFrame, key: str) -> DataFrame:
    """(mention, new, words): every mention in its own writing with its entities'
    surrogates, and the words of a name with theirs."""
    parsed = cut(_parsed(mentions))
    given = parsed.join(assign_surrogates(parsed, key), ["kind", "normal"])
    parts = given.groupBy("mention").agg(F.array_sort(F.collect_list(F.struct("part", "kind", "normal", "surrogate"))).alias("p"))
    m, first = F.col("mention"), F.col("p")[0]
    digits, fresh = F.regexp_replace(m, "[^0-9]", ""), first["surrogate"]
    # of a phone number the last ten digits are the entity; what stands before them stays
    whole = F.concat(digits.substr(F.lit(1), F.length(digits) - F.length(fresh)), fresh)
    solid = F.regexp_replace(m, " ", "")
    woven = lambda mark, new: F.array_join(F.transform(_chars(m), lambda c, i: F.when(
        c.rlike(mark), new.substr(F.length(F.regexp_replace(m.substr(F.lit(1), i + 1), f"(?!{mark}).", "")), F.lit(1)))
        .otherwise(c)), "")
    titled = F.regexp_extract(m, rf"^((?:{_TITLE})\.?) ", 1)
    words = F.split(F.regexp_replace(m, rf"^(?:{_TITLE})\.? ", ""), " ")
    pairs = F.transform("p", lambda x: F.struct(words[x["part"]].alias("old"), F.when(
        F.upper(x["normal"]) == words[x["part"]], F.upper(x["surrogate"])).otherwise(x["surrogate"]).alias("new")))
    is_name = first["kind"].rlike("^(given|family)-")
    name = F.concat_ws(" ", titled, F.array_join(F.transform(pairs, lambda x: x["new"]), " "))
    new = F.when(first["kind"].isin("phone", "ssn", "card"), woven("[0-9]", whole)) \
        .when((first["kind"] == "iban") & (solid != m), woven("[^ ]", fresh)) \
        .when(first["kind"].isin("secret", "pem"), F.concat(m.substr(F.lit(1), F.length(m) - F.length(first["normal"])), fresh)) \
        .when(is_name, name).otherwise(fresh)
    return parts.select("mention", new.alias("new"), F.when(is_name, pairs).alias("words"))


def surrogates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: str = KEY,
               count_col: str | None = None) -> DataFrame:
    """``docs``, columns as they were, with every mention in ``text_col`` replaced
    (and, with ``count_col``, the number of mentions; a column of that name is
    replaced).  The words of a titled name are replaced wherever they stand in that
    text, so "Dr John Smith", "John Smith" and "Smith" stay one person.

    Null and empty texts stay as they are; very long texts are read whole; repeated
    rows come out alike and in their number; an empty table stays empty; other
    columns pass through, whatever their names.  Rows without a mention pass
    through; the others are joined with the replacements of their distinct mentions
    by a hash of id and text.
    """
    docs = docs.drop(count_col) if count_col else docs
    k1, k2, found, new, names = unused(docs, "__k1", "__k2", "__found", "__new", "__names")
    text, counted = F.col(text_col), [F.lit(0).cast("long").alias(count_col)] if count_col else []
    some = _some(text)
    rest = docs.filter(~some).select("*", *counted)
    held = cut(docs.filter(some).select(
        "*", F.xxhash64(F.col(id_col), text).alias(k1), F.xxhash64(F.lit(1), text, F.lit(2), F.col(id_col)).alias(k2),
        F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)).alias(found)))
    mentions = cut(held.select(F.col(k1).alias("a"), F.col(k2).alias("b"), F.explode(F.array_distinct(found)).alias("mention")).distinct())
    given = mentions.join(cut(_replacements(mentions.select("mention").distinct(), key)), "mention")
    maps = given.groupBy("a", "b").agg(F.map_from_entries(F.collect_list(F.struct("mention", "new"))).alias(new))
    words = given.filter(F.col("words").isNotNull()).select("a", "b", F.explode("words").alias("w")).select(
        "a", "b", F.explode(F.array(F.col("w"), F.struct(F.upper("w.old").alias("old"), F.upper("w.new").alias("new")))).alias("w")) \
        .groupBy("a", "b", F.col("w.old").alias("old")).agg(F.min("w.new").alias("fresh")) \
        .groupBy("a", "b").agg(F.map_from_entries(F.collect_list(F.struct("old", "fresh"))).alias(names))
    both = maps.join(words, ["a", "b"], "left").withColumnsRenamed({"a": k1, "b": k2})
    joined = held.join(both, [k1, k2], "left")
    put = F.transform(found, lambda x: F.coalesce(F.col(new)[x], x))
    named = lambda piece: F.when(F.col(names).isNull(), piece).otherwise(F.array_join(F.transform(
        F.regexp_extract_all(piece, F.lit(r"\p{L}+(?:['’-]\p{Lu}\p{L}*)*|\P{L}+"), F.lit(0)), lambda x: F.coalesce(F.col(names)[x], x)), ""))
    pieces = F.zip_with(F.split(text, PATTERN, -1), put, lambda a, b: F.concat(named(a), F.coalesce(b, F.lit(""))))
    columns = [F.array_join(pieces, "").alias(text_col) if c == text_col else F.col(c) for c in docs.columns]
    replaced = F.size(F.filter(found, lambda x: F.col(new)[x].isNotNull())).cast("long")
    counted = [F.coalesce(replaced, F.lit(0)).alias(count_col)] if count_col else []
    return rest.unionAll(joined.select(*columns, *counted))
