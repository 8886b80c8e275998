"""Phrase collocations: two- and three-word phrases whose words occur together far more often than apart.

Method: prefix-free parsing.

1. Every piece of text is cut into chunks wherever a hash of two neighbouring words says so; chunks overlap by those
   two words.  Equal passages are cut alike, so repeats become one entry of the dictionary of distinct chunks, with
   the number of times the parse uses it.
2. n-grams are counted inside distinct chunks, weighted by that number.  Words that a chunk shares with the one before
   it (``lead``) are counted there only, so every occurrence counts once.
3. Hashed two-word counts, sent packed to buckets of the hash, show which pairs can reach ``min_count`` at all (a
   shared hash only lets more through).
   Exact counts by text are made for single words, for those pairs, and for triples whose two pairs are both left.
4. Joins on the counted phrases give the parts' frequencies, the weakest cut and the longer phrases that stand for a
   shorter one.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthwise.llm.batches import packed, unpacked
from monthwise.llm.common import col, partitions, written
from monthwise.llm.words import U, mix, pieces

#: One chunk in about this many words; a run without a hashed cut is cut after LONGEST words.
MODULUS = 12
LONGEST = 64
BLOCK_BYTES = 1 << 20
BATCH_BYTES = 8 << 20
BUCKET_PAIRS = 1 << 20
BYTES_PER_WORD = 6
PAIR = U(0x9E3779B97F4A7C15)

#: A-Z lower-cased, piece separators as one byte that UTF-8 never has, tabs as blanks.
CUT = b"\xff"
PLAIN = bytes(255 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b
              for b in range(256))


def _blocks(raw: bytes, size: int = BLOCK_BYTES) -> Iterator[tuple[bytes, int]]:
    """Blocks of about ``size`` bytes, cut at a word's end; with each, how many of its first words the last one had."""
    end_of_word, carry, begin = regex.compile(rb"[ \xff]"), [], 0
    while begin < len(raw):
        found = end_of_word.search(raw, begin + size) if len(raw) - begin > size else None
        end = found.start() if found else len(raw)
        block = b" ".join((*carry, raw[begin:end]))
        yield block, len(carry)
        carry, begin = block.rpartition(CUT)[2].split()[-2:], end


def _chunks(raw: bytes, lead: int, modulus: int) -> Iterator[tuple[int, bytes]]:
    """(lead, chunk) of a block whose first ``lead`` words were counted before; pieces are separated by ``CUT``."""
    tokens = raw.replace(CUT, b" \xff ").split()
    coded = pa.array(tokens, pa.binary()).dictionary_encode()
    vocabulary = coded.dictionary.to_pylist()
    code = coded.indices.to_numpy()
    is_cut = code == (vocabulary.index(CUT) if CUT in vocabulary else -1)
    at = np.flatnonzero(~is_cut)
    if not len(at):
        return
    piece, code = np.cumsum(is_cut)[at], code[at]
    words = [tokens[i] for i in at.tolist()]
    last = np.append(piece[1:] != piece[:-1], True)
    first = np.append(True, last[:-1])
    place = np.arange(len(at))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, vocabulary), U, len(vocabulary))[code]
    cut = np.zeros(len(at), dtype=bool)
    cut[:-1] = mix(hashes[:-1] * PAIR + hashes[1:]) % U(modulus) == 0
    inside = ~first & ~last & ~np.append(last[1:], True)  # a cut leaves a word before and one after its two
    cut &= inside
    far = place - np.maximum.accumulate(np.where(cut | first, place, 0))
    start = np.flatnonzero(first | cut | (inside & (far > 0) & (far % LONGEST == 0)))
    end_of_piece = np.flatnonzero(last)[np.cumsum(first)[start] - 1]
    end = np.minimum(end_of_piece, np.append(start[1:] + 1, len(at)))
    leads = np.where(first[start], 0, 2)
    if lead and piece[0] == 0:
        leads[0] = lead
    size = np.fromiter(map(len, vocabulary), np.int64, len(vocabulary))[code]
    offset = np.concatenate(([0], np.cumsum(size + 1)))
    joined = b" ".join(words)
    for n, i, j in zip(leads.tolist(), offset[start].tolist(), (offset[end] + size[end]).tolist()):
        yield n, joined[i:j]


def _parse(modulus: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", 4 << 20, 20_000):
                short, found = defaultdict(list), defaultdict(Counter)
                for lang, text in zip(part["lang"].to_pylist(), part["text"].to_pylist()):
                    raw = text.encode().translate(PLAIN) if text else b""
                    if len(raw) <= BLOCK_BYTES:
                        short[lang].append(raw)
                    else:
                        for block, lead in _blocks(raw):
                            found[lang].update(_chunks(block, lead, modulus))
                for lang, raws in short.items():
                    found[lang].update(_chunks(CUT.join(raws), 0, modulus))
                for lang, chunks in found.items():
                    yield pa.RecordBatch.from_pydict({
                        "lang": pa.array([lang] * len(chunks), pa.string()),
                        "lead": pa.array([n for n, _ in chunks], pa.int32()),
                        "chunk": pa.array([c for _, c in chunks], pa.binary()).cast(pa.string()),
                        "uses": pa.array(chunks.values(), pa.int64())})
    return run


class _Grams:
    """Word codes of one language's chunks in a batch; ``uses`` and the first place to count from, for every word."""

    def __init__(self, chunks: list, leads: np.ndarray, uses: np.ndarray):
        tokens = [c.split(b" ") for c in chunks]
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        coded = pa.array([w for t in tokens for w in t], pa.binary()).dictionary_encode()
        self.vocabulary, self.code = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        start = np.cumsum(sizes) - sizes
        self.place = np.arange(len(self.code)) - np.repeat(start, sizes)
        self.left = np.repeat(sizes, sizes) - self.place
        self.lead, self.uses = np.repeat(leads, sizes), np.repeat(uses, sizes)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.vocabulary), U, len(self.vocabulary))
        self.hash = hashes[self.code]

    def at(self, n: int) -> np.ndarray:
        """Where n-grams start that are counted here: whole inside the chunk, ending past its lead."""
        return np.flatnonzero((self.left >= n) & (self.place + n > self.lead))

    def pair_hash(self, at: np.ndarray, salt: int) -> np.ndarray:
        return mix(mix(self.hash[at] + U(salt)) * PAIR + self.hash[at + 1])

    def counted(self, at: np.ndarray, n: int) -> tuple[list, np.ndarray]:
        """Distinct n-grams at these places as text, and their uses."""
        if not len(at):
            return [], np.empty(0, dtype=np.int64)
        order = at[np.lexsort([self.code[at + k] for k in range(n)])]
        new = np.append(True, np.any([self.code[order[1:] + k] != self.code[order[:-1] + k] for k in range(n)], axis=0))
        words = [[self.vocabulary[c] for c in self.code[order[new] + k].tolist()] for k in range(n)]
        return list(map(b" ".join, zip(*words))), np.add.reduceat(self.uses[order], np.flatnonzero(new))


def _by_language(raw: bytes) -> Iterator[tuple[str, int, _Grams]]:
    table = unpacked(raw)
    for lang in table["lang"].unique().to_pylist():
        own = table.filter(pa.compute.equal(table["lang"], lang))
        yield lang, xxhash.xxh64_intdigest(lang.encode()), _Grams(
            own["chunk"].cast(pa.binary()).to_pylist(), own["lead"].to_numpy().astype(np.int64), own["uses"].to_numpy())


def _pairs(buckets: int):
    """Hashed two-word counts of every batch, packed by bucket of the hash; pairs that an earlier chunk counts are named
    with 0, for triples."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, raw in zip(batch["batch"].to_pylist(), batch["rows"].to_pylist()):
                found, times = [np.empty(0, U)], [np.empty(0, np.int64)]
                for _, salt, grams in _by_language(raw):
                    at = np.flatnonzero(grams.left >= 2)
                    found.append(grams.pair_hash(at, salt))
                    times.append(np.where(grams.place[at] + 2 > grams.lead[at], grams.uses[at], 0))
                pair, uses = np.concatenate(found), np.concatenate(times)
                order = np.argsort(pair, kind="stable")
                pair, uses = pair[order], uses[order]
                new = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.empty(0, np.int64)
                pair, uses = pair[new], np.add.reduceat(uses, new) if len(new) else uses
                bucket = (pair >> U(32)) * U(buckets) >> U(32)  # ascending, as the hashes are
                cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(pair) else new
                ends = np.append(cuts[1:], len(pair)) if len(cuts) else cuts
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array(bucket[cuts].astype(np.int64), pa.int64()),
                    "batch": pa.array(np.full(len(cuts), number), pa.int64()),
                    "pairs": pa.array([pair[i:j].tobytes() for i, j in zip(cuts, ends)], pa.binary()),
                    "uses": pa.array([zstandard.compress(uses[i:j].tobytes(), 1) for i, j in zip(cuts, ends)], pa.binary())})
    return run


def _frequent(min_count: int):
    """What batches sent to a bucket, answered with the pairs that occur ``min_count`` times in all of them together."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        each = [np.frombuffer(x, U) for x in table["pairs"].to_pylist()]
        uses = np.concatenate([np.frombuffer(zstandard.decompress(x), np.int64) for x in table["uses"].to_pylist()])
        pair = np.concatenate(each)
        order = np.argsort(pair, kind="stable")
        ordered = pair[order]
        new = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        keep = np.empty(len(pair), dtype=bool)
        keep[order] = np.repeat(np.add.reduceat(uses[order], new) >= min_count, np.diff(np.append(new, len(pair))))
        ends = np.cumsum([len(x) for x in each])
        return pa.table({"batch": table["batch"], "pairs": pa.array(
            [own[keep[end - len(own):end]].tobytes() for own, end in zip(each, ends.tolist())], pa.binary())})
    return run


def _phrases(key: tuple, chunks: pa.Table, frequent: pa.Table) -> pa.Table:
    """Exact counts of a batch: words, frequent pairs, triples of two frequent pairs; all words as the empty phrase."""
    keep = np.sort(np.concatenate([np.empty(0, U), *(np.frombuffer(x, U) for x in frequent["pairs"].to_pylist())]))
    out = []
    for raw in chunks["rows"].to_pylist():
        for lang, salt, grams in _by_language(raw):
            pairs = np.flatnonzero(grams.left >= 2)
            known = np.zeros(len(grams.code) + 1, dtype=bool)
            known[pairs] = np.isin(grams.pair_hash(pairs, salt), keep)
            triples = grams.at(3)
            for n, at in ((1, grams.at(1)), (2, (a := grams.at(2))[known[a]]),
                          (3, triples[known[triples] & known[triples + 1]])):
                text, uses = grams.counted(at, n)
                if n == 1:
                    text, uses = [*text, b""], np.append(uses, uses.sum())
                out.append(pa.table({"lang": pa.array([lang] * len(text), pa.string()),
                                     "n_words": pa.array([n if t else 0 for t in text], pa.int32()),
                                     "phrase": pa.array(text, pa.binary()).cast(pa.string()),
                                     "uses": pa.array(uses, pa.int64())}))
    return pa.concat_tables(out) if out else pa.schema(
        [("lang", pa.string()), ("n_words", pa.int32()), ("phrase", pa.string()), ("uses", pa.int64())]).empty_table()


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 10,
                  modulus: int = MODULUS) -> DataFrame:
    """(lang, n_words, phrase, n): phrases of one to three words that occur at least ``min_count`` times.

    The empty phrase of 0 words stands for all words of a language.
    """
    rows = docs.select(F.coalesce(col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       col(text_col).cast("string").alias("text"))
    dictionary = (rows.mapInArrow(_parse(modulus), "lang string, lead int, chunk string, uses long")
                  .groupBy("lang", "lead", "chunk").agg(F.sum("uses").alias("uses")))
    chunks = packed(dictionary, "chunk", BATCH_BYTES, "chunks")
    # A pair comes once from a batch, so no pair is hot.
    buckets = max(partitions(docs.sparkSession), -(-chunks.count() * (BATCH_BYTES // BYTES_PER_WORD) // BUCKET_PAIRS))
    frequent = (chunks.mapInArrow(_pairs(buckets), "bucket long, batch long, pairs binary, uses binary")
                .groupBy("bucket").applyInArrow(_frequent(min_count), "batch long, pairs binary"))
    counts = (chunks.groupBy("batch").cogroup(frequent.groupBy("batch"))
              .applyInArrow(_phrases, "lang string, n_words int, phrase string, uses long")
              .groupBy("lang", "n_words", "phrase").agg(F.sum("uses").alias("n")))
    return counts.where((F.col("n") >= min_count) | (F.col("n_words") == 0))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 10,
                 top: int = 2000, covered_percent: int = 50, modulus: int = MODULUS) -> DataFrame:
    """Each language's ``top`` phrases of two or three words by how much their parts belong together.

    Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?]`` and line ends, and those into words at blanks and
    tabs.  A phrase that occurs a >= ``min_count`` times is cut after its first or second word; with l and r for how
    often the two parts occur, its score is the smaller floor(1000000 a a / (l r)).  A phrase inside a longer one that
    has at least ``covered_percent`` % of its occurrences goes.  Returns lang, rank, phrase, a, l, r, n (all words of the
    language), score.

    Null text: no words.  Null language: ``und``.  Repeated rows count each; ids aren't read.  Texts without two words
    in a piece give no phrase, an empty table an empty result.  Other columns are dropped, so names can't clash.
    """
    known = written(phrase_counts(docs, text_col, lang_col, min_count, modulus), "phrases")
    totals = known.where("n_words = 0").select("lang", F.col("n").alias("all_words"))
    phrases = known.where("n_words > 1").selectExpr("lang", "n_words", "phrase", "n AS a")
    cuts = phrases.selectExpr("lang", "n_words", "phrase", "a", "explode(sequence(1, n_words - 1)) AS cut").selectExpr(
        "*", "substring_index(phrase, ' ', cut) AS left_part", "substring_index(phrase, ' ', cut - n_words) AS right_part")
    parts = known.select("lang", "phrase", "n")
    scored = (cuts
              .join(parts.selectExpr("lang", "phrase AS left_part", "n AS l"), ["lang", "left_part"])
              .join(parts.selectExpr("lang", "phrase AS right_part", "n AS r"), ["lang", "right_part"])
              .withColumn("score", F.expr("(1000000BD * CAST(a AS DECIMAL(16, 0)) * CAST(a AS DECIMAL(16, 0)))"
                                          " div (CAST(l AS DECIMAL(18, 0)) * CAST(r AS DECIMAL(18, 0)))"))
              .groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.max("n_words").alias("n_words"),
                                             F.min(F.struct("score", "cut", "l", "r")).alias("low")))
    longer = (phrases.where("n_words = 3").selectExpr(
        "lang", "a", "explode(array(substring_index(phrase, ' ', 2), substring_index(phrase, ' ', -2))) AS phrase")
        .groupBy("lang", "phrase").agg(F.max("a").alias("cover")))
    kept = written(scored.join(longer, ["lang", "phrase"], "left")
                   .where(f"n_words = 3 OR cover IS NULL OR 100 * cover < {covered_percent} * a")
                   .selectExpr("lang", "phrase", "a", "low.l", "low.r", "low.score",
                               "CAST(64 * ln(1 + low.score) AS INT) AS band"), "scored")
    # Counts of bands of scores (under 900 a language) tell which ones the top can come from; only these are sorted.
    bands = kept.groupBy("lang", "band").agg(F.count("*").alias("size"))
    above = F.sum("size").over(Window.partitionBy("lang").orderBy(F.desc("band"))) - F.col("size")
    needed = bands.withColumn("above", above).where(F.col("above") < top).select("lang", "band")
    kept = kept.join(needed, ["lang", "band"], "left_semi")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (kept.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
            .join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                    F.col("all_words").alias("n"), "score"))
