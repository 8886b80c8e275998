"""Operators that SQL or a brute-force version can express, and their defined results for odd rows."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from monthwise.llm import queries as Q
from monthwise.llm.components import components
from monthwise.llm.decontamination import contamination
from monthwise.llm.minhash_dedup import bands_for, near_duplicates
from monthwise.llm.packing import best_boundaries, pack
from monthwise.llm.substring_dedup import dedup_substrings
from monthwise.llm.token_counts import token_counts
from monthwise.llm.topk_products import top_products
from monthwise.llm.warc import archive_pages, read_archive, use_warc
from monthwise.llm.words import shingle_sets

from .conftest import MEDIUM, SMALL, multiset, run_sql


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_matches_sql(spark, name):
    got = Q.QUERIES[name](spark, SMALL)
    columns, rows = run_sql(Q.ORACLE_SQL[name], SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert multiset(got.columns, got.collect()) == multiset(columns, rows)


def test_every_query_has_sql_or_a_test_here():
    assert {n.split("_")[0] for n in Q.QUERIES} == {f"op{i}" for i in range(1, 14)}


# --- substring dedup -------------------------------------------------------------------------------------------------

def plain_dedup(rows, k=13):
    """{(id, text): (n_words, kept text)} by comparing all windows."""
    first = {}
    for i, text in rows:
        w = (text or "").encode().split()
        for p in range(len(w) - k + 1):
            if i is not None:
                s = tuple(w[p:p + k])
                first[s] = min(first.get(s, i), i)
    out = {}
    for i, text in rows:
        w = (text or "").encode().split()
        gone = set()
        for p in range(len(w) - k + 1):
            if i is not None and first[tuple(w[p:p + k])] < i:
                gone.update(range(p, p + k))
        out[i, text] = (len(w), b" ".join(x for j, x in enumerate(w) if j not in gone).decode())
    return out


def test_substring_dedup_odd_rows(spark, odd_documents):
    want = plain_dedup([(r.doc_id, r.text) for r in odd_documents.collect()])
    got = dedup_substrings(odd_documents, carry=("text", "lang", "n_words", "id"))
    assert got.columns == ["doc_id", "text", "lang", "id", "n_words", "n_removed", "kept_text", "removed"]
    found = got.collect()
    assert len(found) == odd_documents.count()
    for r in found:
        n, kept = want[r.doc_id, r.text]
        assert r.kept_text == kept
        assert r.n_removed == n - len(kept.split()) == sum(s.end - s.start for s in r.removed)


def test_substring_dedup_deals_a_carried_text_once(spark):
    same = " ".join(map(str, range(20)))
    docs = spark.createDataFrame([(1, same, "x"), (2, f"a  b {same}", None), (3, None, "y")], "doc_id long, text string, tag string")
    out = dedup_substrings(docs, carry=("text", "tag"))
    assert out.columns[:3] == ["doc_id", "text", "tag"]
    assert {r.doc_id: (r.text, r.tag, r.n_removed) for r in out.collect()} == {
        1: (same, "x", 0), 2: (f"a  b {same}", None, 20), 3: (None, "y", 0)}
    dealt = out._jdf.queryExecution().optimizedPlan().toString()
    assert dealt.count("text#") and "__carry0" not in dealt and "__carry1" in dealt


def test_substring_dedup_random_texts_and_empty_table(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(40), " ".join(rng.choice("ab") for _ in range(rng.randrange(0, 40)))) for _ in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_dedup(rows)
    for r in dedup_substrings(df, carry=("text",)).collect():
        assert (r.n_words, r.kept_text) == want[r.doc_id, r.text]
    assert dedup_substrings(df.limit(0)).collect() == []


# --- near duplicates -------------------------------------------------------------------------------------------------

def plain_groups(rows, k, percent):
    """(n_shingles, component) per row position, by comparing all pairs; rows are nodes with their own id."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[p:p + k]) for p in range(len(w) - k + 1)} or ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]) and None not in (rows[a][0], rows[b][0]):
            parent[top(a)] = top(b)
    low = {}
    for x, (i, _) in enumerate(rows):
        low[top(x)] = min(low.get(top(x), i), i) if i is not None else None
    return [(len(sets[x]), low[top(x)]) for x in range(len(rows))]


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10 ** 9)}"
    return words


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near_duplicates_families_of_edits(spark, k, percent):
    """Chains and stars of edits: most pairs of a family aren't near each other, but some links hold it together."""
    rng = random.Random(11)
    rows, ids = [], iter(rng.sample(range(10_000), 2000))
    for _ in range(12):
        base = [f"b{rng.randrange(10 ** 6)}" for _ in range(rng.choice([30, 80, 150]))]
        chain = base
        for _ in range(18):
            rows.append((next(ids), " ".join(edited(rng, base, rng.randrange(0, 6)))))
            chain = edited(rng, chain, 1)
            rows.append((next(ids), " ".join(chain)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=k, percent=percent).collect()}
    assert got == {i: x for (i, _), x in zip(rows, plain_groups(rows, k, percent))}


def test_near_duplicates_odd_rows(spark, odd_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    got = near_duplicates(odd_documents, shingle=3, percent=85)
    want = sorted((str(i), n, str(c if i is not None else None), c == i or i is None)
                  for (i, _), (n, c) in zip(rows, plain_groups(rows, 3, 85)))
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in got.collect()) == want
    assert near_duplicates(odd_documents.limit(0)).collect() == []


def test_bands_lose_next_to_nothing():
    for percent in (80, 85, 95):
        bands, rows = bands_for(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= 1e-8


def test_shingle_sets_count_distinct_sequences():
    doc, h = shingle_sets(["a b a b a b", "a b", "", "A B", None, "a"], 3)
    assert np.bincount(doc, minlength=6).tolist() == [2, 1, 0, 1, 0, 1]
    assert h[doc == 1] == h[doc == 3]


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(50)] + [(100, x) for x in range(101, 400)] + [(7, 7), (None, 4), (500, 400)]
    rng.shuffle(links)
    got = dict(components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect())
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 400)}, 400: 400, 500: 400}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []


# --- decontamination -------------------------------------------------------------------------------------------------

def plain_contamination(text, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    w, hit, found = word.findall((text or "").translate(lower)), set(), set()
    for item, t in items:
        s = word.findall((t or "").translate(lower))
        if item is None or not s:
            continue
        for p in range(max(len(s) - 12, 1)):
            seq = s[p:p + 13]
            for q in range(len(w) - len(seq) + 1):
                if w[q:q + len(seq)] == seq:
                    hit.update(range(q, q + len(seq)))
                    found.add(str(item))
    return len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)


def test_contamination_odd_rows_and_short_items(spark, odd_documents):
    items = [(1, " ".join(f"common{i}" for i in range(5, 40))), (2, "one"), (3, "Short--text"), (None, "one"), (4, None),
             (5, "... !"), (1, "head TWO"), (6, "naïve"), (10, "text")]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    texts = odd_documents.where(F.length("text") < 5000)
    got = contamination(texts, bench, carry=("text", "lang", "kept"))
    assert got.count() == texts.count()
    for r in got.collect():
        assert (r.n_words, r.n_hit, r["items"], r.contaminated) == plain_contamination(r.text, items)
        assert r.n_hit == sum(s.end - s.start for s in r.spans) and r.n_items == len(r["items"])
    assert not contamination(odd_documents, bench.limit(0)).where("n_hit > 0 OR contaminated").count()
    assert contamination(odd_documents.limit(0), bench).collect() == []


# --- token counts ----------------------------------------------------------------------------------------------------

def test_token_counts_equal_the_library(spark, odd_documents):
    from tokenizers import Tokenizer
    path = Q.tokenizer_file("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    rng = random.Random(1)
    parts = ["<|endoftext|>", "<|endof", "text|>", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", " ", "​", "a",
             "B", "é", "中", "1", "²", "'s", "'", "'ll", "!", "😀", "́", "\x00", "x" * 300]
    rows = [(i, "".join(rng.choices(parts, k=rng.randrange(30)))) for i in range(500)]
    df = odd_documents.select("doc_id", "text", "n_words").unionByName(
        spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n_words int"))
    texts = [(r.doc_id, r.text or "") for r in df.collect()]
    want = sorted((str(i), len(t.encode()), len(e.ids), len(e.ids) > 512) for (i, t), e in
                  zip(texts, tokenizer.encode_batch([t for _, t in texts], add_special_tokens=False)))
    assert sorted((str(r[0]), *r[1:]) for r in token_counts(df, path).collect()) == want
    assert token_counts(df.limit(0), path).collect() == []


def test_token_count_query_on_the_table(spark):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(Q.tokenizer_file("byte_bpe_50k.json"))
    docs = Q.table(spark, MEDIUM, "documents").select("doc_id", "text").collect()
    want = {d.doc_id: len(e.ids) for d, e in
            zip(docs, tokenizer.encode_batch([d.text or "" for d in docs], add_special_tokens=False))}
    got = Q.QUERIES["op6_token_counts"](spark, MEDIUM).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want and len(got) == len(docs)


# --- top-k products --------------------------------------------------------------------------------------------------

def plain_top(rows, k):
    ok = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in {i for i, _ in ok if i % 50 == 0}:
        found = {(-max(-2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(v, w)))), j) for i, v in ok if i == q
                 for j, w in ok if j != q and len(v) == len(w)}
        out += [(q, r, j, -s) for r, (s, j) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def test_top_products_odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), (rng.normal(size=8) * rng.choice([0.01, 1, 30])).tolist()) for i in range(400)]
    rows += [(1000 + i, [1.0] * 8) for i in range(20)] + [(50, rows[50][1]), (2000, [0.0] * 8), (2050, [1.0, 2.0]),
             (2051, [3.0, 1.0]), (None, [1.0] * 8), (2052, None), (2053, [float("nan")] * 8), (2054, [None] + [1.0] * 7),
             (2055, [float("inf")] * 8), (2100, []), (2101, [])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    got = top_products(df, F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, got.collect())) == plain_top(rows, 5)
    assert top_products(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []


def test_top_products_prunes_by_coordinate_and_saturates(spark):
    """Vectors close to one direction give high local thresholds; huge ones leave the range of doubles and long."""
    rng = np.random.default_rng(4)
    near = [(i, (np.eye(6)[i % 3] * 5 + rng.normal(size=6) * 0.05).tolist()) for i in range(600)]
    huge = [(3000, [2.0 ** 30, 3.0, 1.0]), (3001, [2.0 ** 30, 1.0, 2.0]), (3050, [2.0 ** 29 + 1, 7.0, 5.0]),
            (3100, [1e30, 0.0, 0.0]), (3101, [1e30, 1.0, 0.0])]
    df = spark.createDataFrame(near + huge, "vec_id long, embedding array<double>")
    got = top_products(df, F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, got.collect())) == plain_top(near + huge, 5)


# --- archives --------------------------------------------------------------------------------------------------------

def test_archive_round_trip(spark, tmp_path):
    body, small = "x" * 150, "y" * 50
    rows = [(3, "http://a/", body), (1, "http://b/\r\nEvil: 1", body), (2, None, small), (4, "http://d/é", small),
            (5, "http://e/", None), (None, "http://f/", body), (1, "http://b2/", body), (7, "u", "é" * 100),
            (8, "v", "\r\n\r\n" + "z" * 200_000), (9, "w", "é" * 100)]
    df = spark.createDataFrame([(i, u, h, "response") for i, u, h in rows],
                               "page_id long, url string, html string, record_type string")
    path = f"file://{tmp_path}/archive"
    archive_pages(df, path)
    got = {(r.record_id, r.target_uri): r for r in read_archive(spark, path, verify=True).collect()}
    assert len(got) == len(rows)
    for i, u, h in rows:
        raw = (h or "").encode()
        uri = u and "".join(f"%{ord(c):02X}" if ord(c) < 32 else c for c in u)
        r = got[f"urn:page:{'null' if i is None else i}", uri]
        assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha256(raw).hexdigest())
        first = min((j for j, _, g in rows if g == h and j is not None), default=None) if len(raw) >= 100 else None
        if first is not None and first != i:
            assert (r.record_type, r.refers_to, r.payload) == ("revisit", f"urn:page:{first}", None)
        else:
            assert (r.record_type, r.refers_to, bytes(r.payload)) == ("response", None, raw)
    archive_pages(df.limit(0), f"{path}-empty")
    assert read_archive(spark, f"{path}-empty").collect() == []


def test_archive_filters_reach_the_scan(spark, tmp_path):
    path = f"file://{tmp_path}/archive"
    archive_pages(spark.createDataFrame([(i, f"http://h{i % 3}/{i}", "q" * (90 + i % 40)) for i in range(120)],
                                        "page_id long, url string, html string"), path)
    rows = read_archive(spark, path, payload=False)
    found = rows.where((F.col("record_type") == "revisit") & F.col("target_uri").startswith("http://h1/"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"\bFilter \(", plan)
    whole = [r for r in rows.collect() if r.record_type == "revisit" and r.target_uri.startswith("http://h1/")]
    assert sorted(found.collect()) == sorted(whole) and whole
    assert rows.where(F.col("refers_to").isNull() & F.col("record_id").isin("urn:page:3", "urn:page:39")).count() == 2


def test_archive_reads_foreign_and_uncommitted_files(spark, tmp_path):
    """Plain archives and members without the length field are read; files of unfinished attempts are not."""
    import gzip

    from monthwise.llm.warc import record
    row = {"record_id": "urn:page:1", "record_type": "response", "target_uri": "http://x/", "payload_digest":
           hashlib.sha256(b"abc" * 9000).hexdigest(), "payload_bytes": 27000, "refers_to": None, "payload": b"abc" * 9000}
    other = dict(row, record_id="urn:page:2")
    raw = [record(r, "2024-01-01T00:00:00Z") for r in (row, other)]
    (tmp_path / "a.warc").write_bytes(b"".join(raw))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in raw))
    (tmp_path / "_c.warc.gz").write_bytes(b"broken")
    use_warc(spark)
    for wanted in (True, False):
        got = read_archive(spark, f"file://{tmp_path}", payload=wanted, verify=wanted).collect()
        assert sorted(r.record_id for r in got) == ["urn:page:1"] * 2 + ["urn:page:2"] * 2
        assert {r.payload_bytes for r in got} == {27000}
        assert all((bytes(r.payload) == b"abc" * 9000) if wanted else r.payload is None for r in got)


# --- packing ---------------------------------------------------------------------------------------------------------

def padding(histogram, ends):
    return sum((min(e for e in ends if e >= n) - n) * k for n, k in histogram)


def test_boundaries_are_optimal():
    rng = random.Random(9)
    for _ in range(60):
        histogram = [(n, rng.randrange(1, 20)) for n in rng.sample(range(0, 60), rng.randrange(1, 9))]
        lengths = sorted(n for n, _ in histogram)
        buckets = rng.randrange(1, 6)
        least = min(padding(histogram, [*c, lengths[-1]]) for r in range(buckets)
                    for c in itertools.combinations(lengths[:-1], min(r, len(lengths) - 1)))
        ends = best_boundaries(histogram, buckets)
        assert len(ends) <= buckets and ends == sorted(set(ends))
        assert padding(histogram, ends) == least


def test_pack_fills_batches(spark, odd_documents):
    for df, budget in ((odd_documents, 100), (Q.table(spark, MEDIUM, "documents"), 4096)):
        got = pack(df, buckets=5, budget=budget, carry=("lang",)).collect()
        texts = [len((r.text or "").encode().split()) for r in df.select("text").collect()]
        assert sorted(r.length for r in got) == sorted(texts)
        batches = {}
        for r in got:
            assert r.length <= r.padded
            batches.setdefault((r.bucket, r.batch), []).append(r)
        for b in {r.bucket for r in got}:
            own = sorted(k for k in batches if k[0] == b)
            room = max(1, budget // max(batches[own[0]][0].padded, 1))
            assert [k[1] for k in own] == list(range(len(own)))
            assert all(len(batches[k]) == room for k in own[:-1]) and 0 < len(batches[own[-1]]) <= room
            assert all(sorted(r.slot for r in batches[k]) == list(range(len(batches[k]))) for k in own)
    assert pack(odd_documents.limit(0)).collect() == []


def test_pack_slots_do_not_depend_on_the_order_of_rows(spark, monkeypatch):
    """The same rows dealt otherwise get the same slots; a crowded id and null ids fill theirs without gaps."""
    monkeypatch.setattr("monthwise.llm.packing.SHARE_ROWS", 40)
    rows = [(i, " ".join("w" * (1 + i % 7))) for i in range(120)] + [(5, "w"), (5, "w w"), (None, None)]
    crowd = [(7, "w w w")] * 90 + [(None, "")] * 90
    one, other = (sorted(map(tuple, pack(spark.createDataFrame(r, "doc_id long, text string").repartition(n), budget=12,
                             by_id=True).collect()), key=repr) for r, n in ((rows, 1), (rows[::-1], 5)))
    assert one == other
    got = pack(spark.createDataFrame(rows + crowd, "doc_id long, text string"), budget=12, by_id=True).collect()
    places = {}
    for r in got:
        places.setdefault(r.bucket, []).append(r.batch * max(1, 12 // max(r.padded, 1)) + r.slot)
    assert len(got) == len(rows) + len(crowd)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_pack_query_has_the_least_padding(spark):
    got = Q.QUERIES["op8_packing"](spark, SMALL).collect()
    count = {}
    for r in got:
        count[r.length] = count.get(r.length, 0) + 1
    histogram = sorted(count.items())
    n = len(histogram)  # plain dynamic programming over all start points
    cost = lambda i, j: sum((histogram[j - 1][0] - a) * k for a, k in histogram[i:j])
    costs = {(i, j): cost(i, j) for j in range(1, n + 1) for i in range(j)}
    best = [0] + [costs[0, j] for j in range(1, n + 1)]
    for _ in range(15):
        best = [0] + [min(best[i] + costs[i, j] for i in range(j)) for j in range(1, n + 1)]
    assert sum(r.padded - r.length for r in got) == best[n]
    assert sum(r.padded - r.length for r in got) == padding(histogram, sorted({r.padded for r in got}))


# --- ordinary archives -----------------------------------------------------------------------------------------------

def _record(kind, block, extra=(), content="application/http; msgtype=response"):
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:{kind}>", f"Content-Type: {content}", *extra,
            f"Content-Length: {len(block)}"]
    return ("WARC/1.0\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


@pytest.mark.parametrize("zipped", [False, True])
@pytest.mark.parametrize("payload", [False, True])
def test_ordinary_crawl_archives_are_read(spark, tmp_path, zipped, payload):
    """warcinfo, request, conversion, resource and chunked or length-less responses, long HTTP headers, sha1 digests."""
    import base64
    import gzip
    body = b"5\r\nhello\r\n0\r\n\r\n"
    sha1 = base64.b32encode(hashlib.sha1(body).digest()).decode()
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + body
    long = b"HTTP/1.1 200 OK\r\nX-Long: " + b"x" * 9000 + b"\r\nContent-Length: 3\r\n\r\nabc"
    records = {
        "warcinfo": (_record("warcinfo", b"software: x\r\n", content="application/warc-fields"), 13, b"software: x\r\n"),
        "request": (_record("request", b"GET / HTTP/1.1\r\nHost: h\r\n\r\n", content="application/http; msgtype=request"), 0, b""),
        "response": (_record("response", chunked, [f"WARC-Payload-Digest: sha1:{sha1}"]), len(body), body),
        "conversion": (_record("conversion", "plain text é".encode(), content="text/plain"), 13, "plain text é".encode()),
        "metadata": (_record("metadata", b"", content="application/warc-fields"), 0, b""),
        "resource": (_record("resource", b"\r\n\r\n", content="image/png"), 4, b"\r\n\r\n"),
        "revisit": (_record("revisit", b"HTTP/1.1 200 OK\r\nContent-Length: 77\r\n\r\n"), 77, None),
        "continuation": (_record("continuation", long), 3, b"abc"),
    }
    raw = [r for r, _, _ in records.values()]
    name = "a.warc.gz" if zipped else "a.warc"
    (tmp_path / name).write_bytes(b"".join(map(gzip.compress, raw)) if zipped else b"".join(raw))
    got = {r.record_type: r for r in read_archive(spark, f"file://{tmp_path}", payload=payload, verify=True).collect()}
    assert {k: r.payload_bytes for k, r in got.items()} == {k: n for k, (_, n, _) in records.items()}
    for kind, (_, _, want) in records.items():
        have = got[kind].payload
        assert (have is None) if not payload or want is None else bytes(have) == want


# --- large benchmarks, long texts, and rows that share an id ------------------------------------------------------------

def test_contamination_by_shuffle_join_gives_the_same(spark):
    """Without any broadcast both sides are dealt by the hash, documents by single windows."""
    docs, benchmark = Q.table(spark, SMALL, "documents"), Q.table(spark, SMALL, "benchmark")
    want = sorted(map(repr, contamination(docs, benchmark).collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = contamination(docs, benchmark)
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in text
        assert sorted(map(repr, df.collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_boundaries_of_long_texts_are_real_lengths(spark):
    lengths = [1, 5, 8192, 8193, 8193, 65_537, 70_001, 70_003]
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)] + [(None, 8193)] * 4, "doc_id long, n long")
    got = pack(rows.withColumn("text", F.lit("")), buckets=3, budget=20_000, length=F.col("n")).collect()
    every = lengths + [8193] * 4
    want = best_boundaries([(n, every.count(n)) for n in sorted(set(every))], 3)
    assert sorted({r.padded for r in got}) == want and set(want) <= set(lengths)
    assert len({(r.bucket, r.batch, r.slot) for r in got}) == len(every)


def test_pipeline_keeps_one_row_of_each_group(spark):
    import corpus_pipeline
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, c), (3, c), (3, a), (8, a), (9, b), (9, b), (None, c), (None, c), (None, None), (10, None), (10, None), (11, "")]
    docs = spark.createDataFrame([(i, t, "x", len(t or "")) for i, t in rows], "doc_id long, text string, text_hash string, n_chars int")
    got = corpus_pipeline.near_dedup(spark, docs, SMALL)
    assert got.columns == docs.columns
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=key) == sorted(
        [(1, c), (3, a), (9, b), (None, c), (None, c), (None, None), (10, None), (11, "")], key=key)
