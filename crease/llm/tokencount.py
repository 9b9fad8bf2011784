"""Token counts under a unigram segmentation, by dynamic programming that the
distinct words of a trie share."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField

from crease.llm.wordshuffle import word_values

PIECES = "piece_bpe_32k.model"
MARK = "▁"


def unigram_costs(path: str | None = None) -> tuple[dict[str, int], int]:
    """Cost of every piece in thousandths of a nat, and the cost of one raw byte.

    The vocabulary lists its pieces by falling frequency, so the n-th has
    probability near 1 / (n * H): cost ``ln(n * H)`` (Zipf's law).  Characters
    that no piece holds fall back to their bytes, each as rare as the last piece.
    """
    import public_tokenizers
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(PIECES))
    names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
             if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    total = sum(1 / n for n in range(1, len(names) + 1))
    costs: dict[str, int] = {}
    for n, name in enumerate(names, 1):
        costs.setdefault(name, round(1000 * math.log(n * total)))
    return costs, round(1000 * math.log(len(names) * total))


def words_of(text: str) -> list[str]:
    """Maximal runs without white space, each led by the mark of a word start."""
    return [MARK + w for w in text.split()]


def trie_counts(words: list[str], costs: dict[str, int], byte_cost: int, longest: int) -> list[int]:
    """Tokens in the cheapest segmentation of each of the sorted ``words``
    (equal cost: the fewest tokens).

    Sorted words are a depth-first walk of their trie: the path to the present
    node is kept as a stack of forward states (cost, tokens), one per character,
    and a word goes on from the deepest node it shares with the word before it.
    """
    counts, path, before = [], [(0, 0)], ""
    get = costs.get
    for word in words:
        shared = 0
        for a, b in zip(before, word):
            if a != b:
                break
            shared += 1
        del path[shared + 1:]
        for end in range(shared + 1, len(word) + 1):
            size = len(word[end - 1].encode())
            cost, tokens = path[end - 1]
            best = (cost + size * byte_cost, tokens + size)
            for start in range(max(0, end - longest), end):
                piece = get(word[start:end])
                if piece is not None:
                    cost, tokens = path[start]
                    best = min(best, (cost + piece, tokens + 1))
            path.append(best)
        counts.append(path[len(word)][1])
        before = word
    return counts


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                 **chunking) -> DataFrame:
    """``(id_col, n_words, n_tokens)``, one row per row of ``docs``.

    Null, empty and blank texts have no words and no tokens; repeated rows give
    a row each; a null id stays null; an empty table stays empty.
    """
    costs, byte_cost = unigram_costs(path)
    shared = docs.sparkSession.sparkContext.broadcast((costs, byte_cost, max(map(len, costs))))

    def split():
        return words_of

    def value_of():
        table, raw, longest = shared.value
        return lambda words: [n.to_bytes(4, "little") for n in
                              trie_counts([w.decode() for w in words], table, raw, longest)]

    def assemble(values: list[bytes]):
        each = np.frombuffer(b"".join(values), "<u4").astype(np.int64)
        return lambda seq: (len(seq) << 32) + int(each[seq].sum())

    out = word_values(docs, id_col, text_col, split, value_of, assemble, StructField("both", LongType()), **chunking)
    return out.select(F.col("id").alias(id_col), F.shiftright("both", 32).alias("n_words"),
                      F.col("both").bitwiseAND(F.lit((1 << 32) - 1)).alias("n_tokens"))
