"""Spelling variants: words of a vocabulary that differ by one inserted, deleted or replaced letter, and their forms.

Method: bit-sliced position index.

1. Words are counted per batch of texts and summed in Spark; frequent ones of some length are the vocabulary.
2. Two words one edit apart agree on a half of the shorter one's length: what lies before the edit or what lies behind
   it.  Words are dealt by these halves, so every near pair meets in a group.  A group of more than ``GROUP`` words is
   dealt again by halves of what is still open, until an open part of one letter bounds it; no group is cut or dropped.
3. Groups are packed into indexes of about ``INDEX_LETTERS`` letters.  An index has a bitset over its words per
   (position, letter).  A query word runs through its letters once; four bitsets follow, for all words of the index at
   once, which agree so far, which have one letter replaced, one too many (positions shifted up) or one missing
   (positions shifted down).
4. Joins give every word its most frequent near word; forms are followed to their roots by doubling.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.llm.common import col, partitions, written
from monthwise.llm.words import pieces

#: Latin-1 letters, A-Z lower-cased; everything else is a blank.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
BLOCK_BYTES = 1 << 20
GROUP = 2048
INDEX_LETTERS = 1 << 16
BUCKET_WORDS = 1 << 16
QUERIES = 512


def _runs(text: str) -> Counter:
    """Lower-cased letter runs of a text, as Latin-1."""
    raw, found, begin = text.encode("latin-1", "replace").translate(LETTERS), Counter(), 0
    while begin < len(raw):
        end = raw.find(b" ", begin + BLOCK_BYTES)
        end = len(raw) if end < 0 else end
        found.update(raw[begin:end].split())
        begin = end
    return found


def _with_typos(runs: Counter, doc_id: str, every: int, shortest: int) -> Iterator[tuple[bytes, int]]:
    """Runs that can become words; where ``every`` divides the crc32 of "id:run", the run loses a letter."""
    seed = zlib.crc32(f"{doc_id}:".encode())
    for run, n in runs.items():
        if len(run) >= shortest:
            if every:
                h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
                if h % every == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
            yield run, n


def _counts(every: int, shortest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", 16 << 20, 20_000):
                found: Counter = Counter()
                for doc_id, text in zip(part["id"].to_pylist(), part["text"].to_pylist()):
                    if text:
                        for word, n in _with_typos(_runs(text), doc_id or "", every, shortest):
                            found[word] += n
                words = [w for w in found if len(w) >= shortest]
                yield pa.RecordBatch.from_pydict({
                    "word": pa.array([w.decode("latin-1") for w in words], pa.string()),
                    "n": pa.array([found[w] for w in words], pa.int64())})
    return run


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 6, least: int = 5,
               typo_every: int = 0) -> DataFrame:
    """(word, n): letter runs of at least ``shortest`` letters that occur at least ``least`` times."""
    rows = docs.select(col(id_col).cast("string").alias("id"), col(text_col).cast("string").alias("text"))
    return (rows.mapInArrow(_counts(typo_every, shortest), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least))


def _halves(rows: DataFrame) -> DataFrame:
    """Rows (word, n, m, head, tail) dealt again: the edit lies in the later or in the earlier half of the open part.

    Of a word in class ``m`` (the shorter length of a pair) the first ``head`` and the last ``tail`` letters are shared
    by its group; m - head - tail letters of the shorter word are open.
    """
    k = "((m - head - tail) div 2)"
    return rows.selectExpr("word", "n", "m", f"""inline(array(
        named_struct('head', CAST(head + {k} AS INT), 'tail', tail),
        named_struct('head', head, 'tail', CAST(m - head - {k} AS INT))))""")


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("key", F.expr(
        "xxhash64(m, head, tail, substring(word, 1, head), right(word, tail))"))


def candidate_groups(words: DataFrame, group: int = GROUP) -> DataFrame:
    """(word, n, m, key): groups of two words or more in which every pair of words one edit apart meets.

    Words with the same key by chance only make a group larger.
    """
    shortest = words.agg(F.min(F.length("word")).alias("s")).first()["s"] or 1
    rows = words.selectExpr("word", "n", "explode(array(length(word), length(word) - 1)) AS m").where(
        F.col("m") >= shortest).selectExpr("word", "n", "m", "0 AS head", "0 AS tail")
    out = None
    while True:
        rows = written(_keyed(_halves(rows)), "spelling-keys")
        sizes = rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
        sized = rows.join(sizes, "key")
        large = f"size > {group} AND m - head - tail > 1"
        part = sized.where(f"NOT ({large})").select("word", "n", "m", "key")
        out = part if out is None else out.unionByName(part)
        if sizes.where(F.col("size") > group).isEmpty():
            return out
        rows = sized.where(large).select("word", "n", "m", "head", "tail")
        if rows.isEmpty():
            return out


class BitIndex:
    """Bitsets over words, one per (position, letter)."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        start = np.cumsum(self.length) - self.length
        self.letters = np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int64)
        owner = np.repeat(np.arange(len(words)), self.length)
        self.start = start
        self.slot = (np.arange(len(owner)) - start[owner]) * 256 + self.letters
        self.slots = np.unique(self.slot)
        self.width = -(-len(words) // 64) * 64
        dense = np.zeros((len(self.slots) + 1, self.width), dtype=bool)  # the last row: no word
        dense[np.searchsorted(self.slots, self.slot), owner] = True
        self.bits = np.packbits(dense, axis=1, bitorder="little").view(np.uint64)

    def of_length(self, n: int) -> np.ndarray:
        return np.packbits(np.pad(self.length == n, (0, self.width - len(self.words))), bitorder="little").view(np.uint64)

    def at(self, position: int, letters: np.ndarray) -> np.ndarray:
        """Words that have these letters at a position, one row per letter."""
        slot = position * 256 + letters
        row = np.minimum(np.searchsorted(self.slots, slot), len(self.slots) - 1)
        return self.bits[np.where(self.slots[row] == slot, row, len(self.slots))]

    def near(self, queries: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) pairs one edit apart, for words of length ``m`` of the index as queries."""
        letters = self.letters[self.start[queries][:, None] + np.arange(m)]
        same = np.full((len(queries), self.width // 64), ~np.uint64(0))
        replaced, longer, shorter = np.zeros_like(same), np.zeros_like(same), np.zeros_like(same)
        for i in range(m):
            here = self.at(i, letters[:, i])
            replaced = (replaced & here) | (same & ~here)
            longer = (longer | same) & self.at(i + 1, letters[:, i])
            shorter = (shorter & self.at(i - 1, letters[:, i]) if i else shorter) | same
            same &= here
        found = ((replaced & self.of_length(m)) | ((longer | same) & self.of_length(m + 1))
                 | (shorter & self.of_length(m - 1)))
        q, block = np.nonzero(found)
        bits = np.unpackbits(found[q, block].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        hit, bit = np.nonzero(bits)
        return queries[q[hit]], block[hit] * 64 + bit

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for m in np.unique(self.length).tolist():
            own = np.flatnonzero(self.length == m)
            for i in range(0, len(own), QUERIES):
                yield self.near(own[i:i + QUERIES], m)


def _search(key: tuple, table: pa.Table) -> pa.Table:
    """Near pairs of the groups of a bucket, an index at a time."""
    table = table.sort_by([("m", "ascending"), ("key", "ascending")])
    word = table["word"].to_pylist()
    group, m, n = table["key"].to_numpy(), table["m"].to_numpy(), table["n"].to_pylist()
    edges = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group)).tolist()
    out = [pa.table({"word": pa.array([], pa.string()), "near": pa.array([], pa.string()),
                     "near_n": pa.array([], pa.int64())})]

    def search(i: int, j: int) -> None:
        count = dict(zip(word[i:j], n[i:j]))
        words = [w.encode("latin-1") for w in count]
        counts, names = np.fromiter(count.values(), np.int64, len(count)), np.array(list(count), dtype=object)
        for q, w in BitIndex(words).pairs():
            if len(q):
                out.append(pa.table({"word": pa.array(names[q], pa.string()), "near": pa.array(names[w], pa.string()),
                                     "near_n": pa.array(counts[w], pa.int64())}))
    begin = size = 0
    for i, j in zip(edges, edges[1:]):
        own = sum(map(len, word[i:j]))
        if i > begin and (size + own > INDEX_LETTERS or m[i] > 2 * m[begin]):
            search(begin, i)
            begin, size = i, 0
        size += own
    if begin < len(group):
        search(begin, len(group))
    return pa.concat_tables(out)


def near_words(words: DataFrame, group: int = GROUP) -> DataFrame:
    """(word, near, near_n): all ordered pairs of words of a vocabulary (word, n) that are one edit apart."""
    groups = written(candidate_groups(words, group), "spelling-groups")
    buckets = max(partitions(words.sparkSession), groups.count() // BUCKET_WORDS)
    return (groups.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
            .groupBy("bucket").applyInArrow(_search, "word string, near string, near_n long").distinct())


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 6,
                      least: int = 5, ratio: int = 5, typo_every: int = 0, group: int = GROUP) -> DataFrame:
    """Groups words with the more frequent words that they are one letter away from.

    Words are the runs of Latin-1 letters of all texts (A-Z lower-cased), of ``shortest`` letters and ``least``
    occurrences at least.  Two are near if they differ by exactly one inserted, deleted or replaced letter.  A word's
    form is its most frequent near word (ties: the smallest), if that has ``ratio`` (over 1) times its occurrences or more; its
    root is where forms lead.  Returns word, form, root, n, n_near, form_n.  With ``typo_every``, a run loses a letter
    where that number divides the crc32 of "id:run" (known typos to measure the grouping by).

    Null text: no words; a null id is an empty string to ``typo_every``; repeated rows count each; a long text is read
    block by block.  An empty table gives an empty result.  Other columns are dropped, so names can't clash.
    """
    if ratio < 2:
        raise ValueError("ratio must be over 1, so that forms can't run in circles")
    words = written(vocabulary(docs, id_col, text_col, shortest, least, typo_every), "vocabulary")
    near = near_words(words, group).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus_n"), "near")).alias("best"))
    forms = written(words.join(near, "word", "left").selectExpr(
        "word", "n", "coalesce(n_near, 0) AS n_near", f"CASE WHEN -best.minus_n >= {ratio} * n THEN best.near END AS form",
        f"CASE WHEN -best.minus_n >= {ratio} * n THEN -best.minus_n END AS form_n"), "forms")
    # Counts grow by ``ratio`` from a word to its form, which bounds the steps to a root.
    steps, most = 1, (words.agg(F.max("n").alias("n")).first()["n"] or least) // least
    while most >= ratio:
        most, steps = most // ratio, steps + 1
    roots = forms.selectExpr("word", "coalesce(form, word) AS root")
    for _ in range((steps - 1).bit_length()):
        roots = written(roots.alias("a").join(roots.selectExpr("word AS root", "root AS next"), "root")
                        .selectExpr("word", "next AS root"), "roots")
    return forms.join(roots, "word").select("word", "form", "root", "n", "n_near", "form_n")
