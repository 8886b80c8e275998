"""Collocations, spelling variants and the run-length index against brute force, and their defined results for odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from monthwise.llm import collocations as C
from monthwise.llm import repeat_index as R
from monthwise.llm import spelling_variants as S
from monthwise.llm.collocations import collocations
from monthwise.llm.repeat_index import dedup_bytes
from monthwise.llm.spelling_variants import near_words, spelling_variants, vocabulary

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- collocations ----------------------------------------------------------------------------------------------------

def plain_collocations(rows, least, top, covered=50):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        found = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            if len(p) == 2 and any(100 * b >= covered * a for q, b in found.items()
                                   if len(q) == 3 and p in (q[:2], q[1:])):
                continue
            score, _, l, r = min((10 ** 6 * a * a // (count[p[:k]] * count[p[k:]]), k, count[p[:k]], count[p[k:]])
                                 for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def collocation_rows(seed, n=150):
    rng, langs = random.Random(seed), ["en", "de", None, "und"]
    words = ["a", "b", "cc", "Dd", "é", "x-y", "z z", "w "]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n"])
                       for _ in range(rng.randrange(60)))
        rows += [(i, text, rng.choice(langs))] * rng.choice([1, 1, 1, 4])
    return rows + [(None, None, None), (3, "", "en"), (4, " \t", None)]


@pytest.mark.parametrize("modulus,top", [(2, 2000), (12, 7), (10 ** 9, 2000)])
def test_collocations_match_brute_force(spark, monkeypatch, modulus, top):
    """Whatever the cuts: nearly everywhere, hashed, or none at all."""
    monkeypatch.setattr(C, "BATCH_BYTES", 2000)
    rows = collocation_rows(modulus)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS n", "'q' AS phrase")
    got = collocations(docs, min_count=5, top=top, modulus=modulus)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.repartition(3).collect())) == plain_collocations([r[:0:-1] for r in rows], 5, top)


def test_chunks_of_long_texts_count_every_word_once():
    rng = random.Random(3)
    words = [b"a", b"bb", "é".encode(), b"dddd"]
    raw = b"".join(rng.choice(words) + rng.choice([b" ", b" ", b" ", b" ", C.CUT]) for _ in range(5000))
    want, got = Counter(), Counter()
    for piece in raw.split(C.CUT):
        w = piece.split()
        want.update(tuple(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    for block, lead in C._blocks(raw, 100):
        for n, chunk in C._chunks(block, lead, 12):
            w = chunk.split(b" ")
            assert len(w) <= C.LONGEST + 2
            got.update(tuple(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1) if i + k > n)
    assert got == want


def test_collocation_scores_pass_64_bits(spark):
    a = 4 * 10 ** 9  # 10**6 * a * a is beyond a long
    row = spark.sql(f"SELECT (1000000BD * CAST({a} AS DECIMAL(16, 0)) * CAST({a} AS DECIMAL(16, 0))) div "
                    f"(CAST({a} AS DECIMAL(18, 0)) * CAST({3 * a} AS DECIMAL(18, 0))) AS s").first()
    assert row.s == 10 ** 6 * a * a // (a * 3 * a)


@pytest.mark.parametrize("min_count", [1, 3])
def test_packed_pairs_are_counted_over_batches(min_count):
    """Every batch gets back, from all buckets, just its pairs that occur often enough in all batches together."""
    rng = random.Random(min_count)
    chunks = [[(rng.choice(["a", "b"]), 0, " ".join(rng.choices("pqrstu", k=rng.randrange(1, 6))), rng.randrange(1, 3))
               for _ in range(12)] for _ in range(4)]
    wanted, sent = Counter(), []
    for number, own in enumerate(chunks):
        table = pa.table({n: pa.array(v, t) for n, v, t in zip(("lang", "lead", "chunk", "uses"), zip(*own), (
            pa.string(), pa.int32(), pa.string(), pa.int64()))})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        batch = pa.RecordBatch.from_pydict({"batch": [number], "rows": pa.array([sink.getvalue().to_pybytes()], pa.binary())})
        sent += pa.Table.from_batches(C._pairs(3)(iter([batch]))).to_pylist()
        for lang, _, chunk, uses in own:
            for pair in zip(chunk.split(), chunk.split()[1:]):
                wanted[lang, pair] += uses
    assert {r["bucket"] for r in sent} <= {0, 1, 2}
    got = defaultdict(set)
    for bucket in {r["bucket"] for r in sent}:
        table = pa.Table.from_pylist([r for r in sent if r["bucket"] == bucket])
        for r in C._frequent(min_count)((pa.scalar(bucket),), table).to_pylist():
            got[r["batch"]] |= set(np.frombuffer(r["pairs"], np.uint64).tolist())
    for number, own in enumerate(chunks):
        pairs = {(lang, pair) for lang, _, chunk, _ in own for pair in zip(chunk.split(), chunk.split()[1:])}
        assert len(got[number]) == sum(wanted[p] >= min_count for p in pairs)


def test_collocations_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert collocations(empty).collect() == []


# --- spelling variants -----------------------------------------------------------------------------------------------

def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(rows, shortest, least, ratio, every):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= shortest and c >= least}
    near = {w: [v for v in n if v != w and one_edit(w, v)] for w in n}
    form = {}
    for w, c in n.items():
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * c else None

    def root(w):
        return w if form[w] is None else root(form[w])
    return sorted((w, form[w], root(w), c, len(near[w]), n[form[w]] if form[w] else None) for w, c in n.items())


def variant_rows(seed, n=60):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abéÿ") for _ in range(rng.randrange(3, 9))) for _ in range(80)]
    weight = [5 ** rng.randrange(5) for _ in words]
    rows = [(i, " ".join(rng.choices(words, weight, k=150)).upper() + "÷×1x中" * (i % 2)) for i in range(n)]
    return rows + [(None, "ababab ababab"), (None, None), (7, ""), (7, "aaaaaaa" * 40), (8, "aaaaaaa" * 40 + "b")]


@pytest.mark.parametrize("group,every", [(2048, 0), (3, 7), (1, 0)])
def test_variants_match_brute_force(spark, group, every):
    """With any limit on groups: hot groups are dealt again, none is cut."""
    rows = variant_rows(group)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS word", "0 AS n")
    got = spelling_variants(docs, shortest=4, least=1, ratio=5, typo_every=every, group=group)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == plain_variants(rows, 4, 1, 5, every)


def test_every_near_pair_meets_in_a_hot_group(spark):
    """Words that share all but a few letters: every pair is found, although no group may hold them together."""
    rng = random.Random(9)
    words = sorted({"common" + "".join(rng.choice("abc") for _ in range(rng.randrange(2, 6))) + "ending" for _ in range(400)})
    got = {(r.word, r.near) for r in near_words(spark.createDataFrame([(w, 5) for w in words], "word string, n long"),
                                               group=4).collect()}
    assert got == {(a, b) for a in words for b in words if a != b and one_edit(a, b)}


def test_bit_index_on_all_words_of_three_letters():
    words = [bytes(w) for k in (0, 1, 2, 3, 4) for w in np.ndindex(*[3] * k)]
    index = S.BitIndex([w for w in words if w])
    got = {(index.words[a], index.words[b]) for q, w in index.pairs() for a, b in zip(q, w)}
    assert got == {(a, b) for a in index.words for b in index.words if a != b and one_edit(a, b)}


def test_variants_of_long_texts_and_of_nothing(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_BYTES", 50)
    docs = spark.createDataFrame([(1, "Straße naïve résumé " * 300)], "doc_id long, text string")
    assert sorted(map(tuple, vocabulary(docs).collect())) == [("résumé", 300), ("straße", 300)]
    assert spelling_variants(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        spelling_variants(docs, ratio=1)


# --- run-length index ------------------------------------------------------------------------------------------------

def plain_bytes(rows, k):
    first = {}
    for i, text in rows:
        raw = (text or "").encode()
        for p in range(len(raw) - k + 1):
            if i is not None:
                s = raw[p:p + k]
                first[s] = min(first.get(s, i), i)
    out = []
    for i, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), dtype=bool)
        for p in range(len(raw) - k + 1):
            if i is not None and first[raw[p:p + k]] < i:
                gone[p:p + k] = True
        edges = np.flatnonzero(np.diff(gone.astype(int), prepend=0, append=0)).tolist()
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((i, text, len(raw), int(gone.sum()), kept, list(zip(edges[::2], edges[1::2]))))
    return out


def repeat_rows(seed, n=70):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("ab é\n") for _ in range(rng.choice([30, 60, 140]))) for _ in range(12)]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice([rng.choice(passages), "".join(rng.choice("abcd ") for _ in range(rng.randrange(40)))])
                       for _ in range(rng.randrange(8)))
        rows += [(rng.randrange(40), text)] * rng.choice([1, 1, 2])
    rows += [(50 + i, "a" * i * 7) for i in range(12)] + [(70, "ab" * 300), (71, "x" + "ab" * 90), (None, passages[2] * 3),
                                                        (None, None), (5, None), (6, ""), (7, "\0" * 90), (8, "\0" * 70)]
    return rows


@pytest.mark.parametrize("length,hot", [(50, 8192), (50, 2), (24, 1)])
def test_repeat_index_matches_brute_force(spark, monkeypatch, length, hot):
    """Also where shares are dealt again and again, down to single windows, and with many small batches."""
    monkeypatch.setattr(R, "HOT", hot)
    monkeypatch.setattr(R, "BATCH_BYTES", 900)
    monkeypatch.setattr(R, "INDEX_BYTES", 700)
    rows = repeat_rows(length + hot)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'c' AS kept", "doc_id AS batch")
    got = dedup_bytes(docs, length=length, carry=("text", "batch", "kept"))
    assert got.columns == ["doc_id", "text", "batch", "n_bytes", "n_removed", "kept", "removed"]
    found = [(r.doc_id, r.text, r.n_bytes, r.n_removed, bytes(r.kept), [(s.start, s.end) for s in r.removed])
             for r in got.collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, plain_bytes(rows, length)))


def test_repeat_index_rows_between_units_and_buckets(spark, monkeypatch):
    """Steps exchange a row for each unit and bucket; one for each batch and bucket grew with the square of the input."""
    monkeypatch.setattr(R, "BATCH_BYTES", 2000)
    packed, written, rows = R.packed, R.written, {}

    def counted(make):
        def run(*args):
            out = make(*args)
            rows[args[-1]] = rows.get(args[-1], 0) + out.count()
            return out
        return run
    monkeypatch.setattr(R, "packed", counted(packed))
    monkeypatch.setattr(R, "written", counted(written))
    rng = random.Random(5)
    common = "".join(rng.choice("abcdefgh ") for _ in range(900))
    texts = [(i, "".join(rng.choice("abcdefgh ") for _ in range(990)) + common) for i in range(64)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    found = {r.doc_id: r.n_removed for r in dedup_bytes(docs).collect()}
    assert found == {i: n for i, _, _, n, _, _ in plain_bytes(texts, 50)}
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert rows["texts"] <= 64 // 2 and rows["repeats"] <= rows["texts"] * (buckets + 1)


def test_repeat_index_small_sendings_and_holdings(spark, monkeypatch):
    for name, value in (("BATCH_BYTES", 400), ("SENT_BYTES", 300), ("HELD_BYTES", 1), ("SHARE_ROWS", 3), ("HOT", 3)):
        monkeypatch.setattr(R, name, value)
    rows = repeat_rows(9, n=40)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(3)
    found = [(r.doc_id, r.text, r.n_bytes, r.n_removed, bytes(r.kept), [(s.start, s.end) for s in r.removed])
             for r in dedup_bytes(docs, carry=("text",)).collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, plain_bytes(rows, 50)))


def test_repeat_index_held_contexts_are_coded_as_they_double(monkeypatch):
    """Beyond ``HELD_BYTES`` every added row had all held contexts coded again."""
    monkeypatch.setattr(R, "HELD_BYTES", 1)
    rng, held, coded = random.Random(6), R._Held(50, 8), []
    share = held._share
    monkeypatch.setattr(held, "_share", lambda *args: coded.append(len(args[0])) or share(*args))
    for i in range(200):
        text = bytes(rng.choice(b"abcdefgh") for _ in range(60))
        held.add(*R._entry(0, i, 0, 34, text, [60], [20], [i], [7])[1:])
        assert not [*held.overflow(last=False)]
    assert len(coded) <= 10 and sum(coded) <= 2 * 200


def test_repeat_index_odd_rows_and_nothing(spark, odd_documents):
    want = plain_bytes([(r.doc_id, r.text) for r in odd_documents.collect() if len(r.text or "") < 10_000], 50)
    docs = odd_documents.where("text IS NULL OR length(text) < 10000")
    got = [(r.doc_id, r.text, r.n_bytes, r.n_removed, bytes(r.kept), [(s.start, s.end) for s in r.removed])
           for r in dedup_bytes(docs, carry=("text", "score")).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert dedup_bytes(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        dedup_bytes(docs, length=200)


def test_run_length_samples_give_all_matching_statistics():
    rng = random.Random(1)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 60))) for _ in range(40)] + [b"ab" * 40] * 3
    index = R.RunLengthIndex(texts)
    link, common = index.statistics()
    where = [(k, p) for k, t in enumerate(texts) for p in range(len(t) + 1)]
    order = sorted(range(len(where)), key=lambda x: (texts[where[x][0]][where[x][1]:], where[x][0]))
    suffix = [texts[k][p:] for k, p in where]
    for a, b in zip(order, order[1:]):
        same = next((i for i, (x, y) in enumerate(zip(suffix[a], suffix[b])) if x != y), min(len(suffix[a]), len(suffix[b])))
        assert (link[b], common[b]) == (a, same)
    assert len(index.position) < len(where)


def test_repeat_index_long_text_crosses_blocks(spark, monkeypatch):
    monkeypatch.setattr(R, "BLOCK", 64)
    rng = random.Random(4)
    text = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    rows = [(1, text), (2, text[1000:1400] + "unique tail " * 9), (3, "q" * 10 + text[5:] + "é")]
    got = {r.doc_id: (hashlib.sha256(r.kept).hexdigest(), r.n_removed)
           for r in dedup_bytes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: (hashlib.sha256(kept).hexdigest(), n) for i, _, _, n, kept, _ in plain_bytes(rows, 50)}
