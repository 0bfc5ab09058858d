"""Archives, packing, mixing and search."""

import base64
import gzip
import hashlib
import zlib
from collections import Counter, defaultdict
from urllib.parse import urlparse

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lotledger.llm import annsearch, mixing, packing, queries, warc
from lotledger.llm.common import scratch_dir, table

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def pages_with_copies(spark):
    rows = [(r.page_id, r.url, r.html) for r in table(spark, SF, "pages").limit(20).collect()]
    rows += [(100 + i, f"http://copy/{i}", rows[i % 3][2]) for i in range(12)]
    rows += [(200, None, None), (201, "u\r\nX: y", ""), (None, "n", rows[0][2]), (None, "n", "alone\r\n\r\nWARC/1.1\r\n\r\n"),
             (7, "again", rows[7][2]), (300, "é", "é" * 100_000)]
    return rows, spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, path string, offset int")


@pytest.mark.parametrize("min_bytes", [0, 50])
def test_archives(spark, min_bytes):
    rows, frame = pages_with_copies(spark)
    got = warc.archived(frame.repartition(3), min_bytes).collect()
    sha = lambda x: base64.b32encode(hashlib.sha1((x or "").encode()).digest()).decode()
    assert sorted(repr((r.page_id, r.payload_bytes, r.payload_digest)) for r in got) == sorted(
        repr((i, len((x or "").encode()), sha(x))) for i, _, x in rows)
    best = {}
    for i, _, x in rows:
        best[sha(x)] = max(best.get(sha(x), -1), -1 if i is None else i)
    responses = Counter(r.payload_digest for r in got if r.record_type == "response")
    for r in got:
        if r.payload_bytes < min_bytes:
            assert r.record_type == "response" and r.refers_to is None
        elif r.record_type == "response":
            assert responses[r.payload_digest] == 1 and r.refers_to is None and (-1 if r.page_id is None else r.page_id) == best[r.payload_digest]
        else:
            assert r.record_type == "revisit" and r.refers_to == best[r.payload_digest]


def test_archive_files_are_plain_warc(spark):
    rows, frame = pages_with_copies(spark)
    folder = scratch_dir(spark)
    done = warc.resolve_revisits(warc.write_archives(frame, f"{folder}/raw"), f"{folder}/new")
    places = defaultdict(list)
    for r in done.collect():
        places[r.path].append(r)
    ids, refers = set(), set()
    for path, records in places.items():
        data = open(urlparse(path).path, "rb").read()
        assert sum(r.length for r in records) == len(data)
        whole, at = gzip.decompress(data), 0
        while at < len(whole):  # a reader that knows nothing but the format
            head = whole[at:whole.index(b"\r\n\r\n", at)].decode()
            fields = dict(x.split(": ", 1) for x in head.split("\r\n")[1:])
            begin = at + len(head.encode()) + 4
            at = begin + int(fields["Content-Length"]) + 4
            assert head.startswith("WARC/1.1\r\n") and whole[at - 4:at] == b"\r\n\r\n"
            block = whole[begin:at - 4]
            assert block.startswith(b"HTTP/1.1 200 OK\r\n")
            ids.add(fields["WARC-Record-ID"])
            if fields["WARC-Type"] == "revisit":
                refers.add(fields["WARC-Refers-To"])
                assert block.endswith(b"\r\n\r\n") and fields["WARC-Profile"] == warc.PROFILE
                assert fields["WARC-Refers-To-Date"] == fields["WARC-Date"] and "WARC-Refers-To-Target-URI" in fields
    assert refers and refers <= ids


def test_damage_is_noticed():
    data = warc.record(1, "u", b"payload", 7, warc.digest(b"payload"))
    assert warc.parsed(data)[1] == b"payload"
    with pytest.raises(ValueError):
        warc.parsed(data.replace(b"payload", b"pay1oad"))


def test_archives_empty(spark):
    assert warc.archived(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def check_pieces(rows, pieces, window):
    own = Tokenizer.from_file(TOKENIZER)
    own.encode_special_tokens = True
    want = Counter()
    for i, x in rows:
        want[i, tuple(own.encode(x or "", add_special_tokens=False).ids + [1])] += 1
    by_place = sorted(pieces, key=lambda r: (r.sequence_id, r.offset))
    at, parts, got = 0, [], Counter()
    for r in by_place:  # gapless from the first to the last id
        assert (r.sequence_id, r.offset) == divmod(at, window) and r.offset + r.length <= window
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length > 0 and r.start == sum(map(len, parts))
        parts.append(ids)
        at += r.length
        if r.start + r.length == r.doc_tokens:
            got[r.doc_id, tuple(np.concatenate(parts).tolist())] += 1
            parts = []
    assert got == want and not parts


@pytest.mark.parametrize("window", [2048, 8, 1])
def test_packing(spark, window):
    rows = [(i, x) for i, x in enumerate(
        ["", None, "one", "a  b\n\n c \t", "<|endoftext|> it's we'll ''s", "é 中文 😀  x", "12345 6,7", " lead", "trail  ", "\r\n\r\n"])]
    rows += [(None, "no id"), (3, "again"), (3, "again"), (99, "long word " * (3000 if window > 1 else 20))]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, ids int, unit int").repartition(4)
    check_pieces(rows, packing.packed(frame, TOKENIZER, window).collect(), window)
    assert packing.packed(frame.limit(0), TOKENIZER).count() == 0


def test_packing_of_the_documents(spark):
    docs = table(spark, SF, "documents")
    found = packing.packed(docs, TOKENIZER)
    check_pieces([(r.doc_id, r.text) for r in docs.collect()], found.collect(), 2048)
    plain = {(r.doc_id, r.start): zlib.crc32(r.ids) for r in found.collect()}
    assert {(r.doc_id, r.start): r.ids_crc32 for r in packing.digests(found).collect()} == plain


def test_queries_pack_added_tokens(spark, tmp_path):
    """The queries' ids are those of the tokenizer as the file sets it up, added tokens included."""
    mark = "<|endoftext|>"
    texts = [f"a{mark}b", f"a {mark}  b{mark}{mark} c ", mark, f"  {mark}\n\n{mark} it's", "<|endoftext", f"<{mark}>", f"x  {mark} y", "plain", None]
    spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "doc_id long, text string").coalesce(1).write.parquet(
        f"{tmp_path}/documents.parquet")
    own = Tokenizer.from_file(TOKENIZER)
    want = {i: own.encode(x or "", add_special_tokens=False).ids + [1] for i, x in enumerate(texts)}
    assert want[0] == [64, 50256, 65, 1]
    docs = table(spark, str(tmp_path), "documents")
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in corpus_pipeline.pack(spark, docs, str(tmp_path)).collect()}
    assert got == want
    crcs = {r.doc_id: (r.doc_tokens, r.ids_crc32) for r in queries.op3_packing(spark, str(tmp_path)).collect()}
    assert crcs == {i: (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in want.items()}


def test_schedule_keeps_to_less_than_one_block():
    rng = np.random.default_rng(6)
    for _ in range(20):
        weights = {f"s{i}": float(w) for i, w in enumerate(rng.pareto(0.7, rng.integers(1, 40)) + 1e-3)}
        slots = mixing.shares(weights, 512)
        period, done = sum(slots.values()), Counter()
        plan = mixing.schedule(slots)
        assert [slot for _, _, slot in plan] == list(range(period))
        for s, j, slot in plan:
            assert j == done[s]
            done[s] += 1
            assert all(abs(done[x] * period - slots[x] * (slot + 1)) < period for x in slots)
        assert done == slots


def test_shares():
    assert mixing.shares({"a": 3.0, "b": 1.0}, 400) == {"a": 300, "b": 100}
    few = mixing.shares({"a": 1e9, "b": 1.0, "c": 0.0}, 100)
    assert few["b"] == 1 and sum(few.values()) == 100 and "c" not in few
    assert mixing.shares({}) == {}


def test_mixed(spark):
    """A hot source, a rare one, nulls and repeats: deviation holds until a source runs out."""
    rows = [(i, "hot") for i in range(700)] + [(1000 + i, "b") for i in range(300)] + [(2000 + i, "c") for i in range(40)]
    rows += [(None, "b"), (5, "hot"), (3000, None), (3001, "")]
    frame = spark.createDataFrame([(i, None, s, 1) for i, s in rows], "doc_id long, text string, source string, slot int").repartition(6)
    weights = {"hot": 0.5, "b": 0.4, "c": 0.1}
    got = mixing.mixed(frame, weights, block=4, period=100).collect()
    assert sorted(repr((r.doc_id, r.source)) for r in got) == sorted(repr((i, s or "")) for i, s in rows)
    assert len({r.position for r in got}) == len(rows)
    slots = sorted({(r.slot, r.source) for r in got})
    assert len({s for s, _ in slots}) == len(slots)  # a slot holds one block
    done = Counter()
    left = Counter({s: -(-n // 4) for s, n in Counter(s or "" for _, s in rows).items()})
    for n, (slot, s) in enumerate(slots, 1):
        done[s] += 1
        if any(done[x] == left[x] for x in weights):
            break
        assert slot == n - 1 and all(abs(done[x] - w * n) < 1 for x, w in weights.items())
    assert n > 70
    assert max(r.slot for r in got if r.source != "") < min(r.slot for r in got if r.source == "")
    whole = mixing.interleaved(frame, weights, 4)
    assert whole.columns == frame.columns
    back = whole.collect()
    assert sorted(repr((r.doc_id, r.source)) for r in back) == sorted(repr((i, s)) for i, s in rows)
    place = {}
    for r in mixing.mixed(frame, weights, block=4).collect():
        place[r.doc_id] = min(place.get(r.doc_id, 10**9), r.position)
    order = [place[r.doc_id] for r in back]
    assert order == sorted(order)


def test_mixed_by_counts(spark):
    docs = table(spark, SF, "documents")
    assert mixing.mixed(docs).count() == docs.count()
    assert mixing.mixed(docs.limit(0)).count() == 0 and mixing.interleaved(docs.limit(0)).count() == 0


def check_mix(got, left, weights):
    """The n-th slot holds one block, and shares deviate by less than one, until a source runs out."""
    total, done = sum(weights.values()), Counter()
    slots = sorted({(r.slot, r.source, r.block) for r in got})
    for n, (slot, s, j) in enumerate(slots, 1):
        assert j == done[s]
        done[s] += 1
        if done[s] == left[s]:
            return n
        assert slot == n - 1 and all(abs(done[x] * total - w * n) < total * (1 + 1e-9) for x, w in weights.items())
    return len(slots)


def test_mix_keeps_to_the_target_over_many_periods(spark):
    counts = {f"s{i}": 900 + 37 * i for i in range(20)} | {"hot": 30_000}
    frame = spark.createDataFrame([(i, s) for s, n in counts.items() for i in range(n)], "doc_id long, source string")
    weights = {s: n ** mixing.POWER for s, n in counts.items()}
    got = mixing.mixed(frame, block=1, chunk=300).collect()
    assert len(got) == sum(counts.values()) == len({r.position for r in got})
    assert check_mix(got, counts, weights) > 3 * mixing.PERIOD
    # The chunks are those of one walk over the slots.
    assert {(r.slot, r.source, r.block) for r in got} == {
        (r.slot, r.source, r.block) for r in mixing.mixed(frame, block=1, chunk=10**9).collect()}


def test_mix_of_tiny_sources(spark):
    counts = {f"s{i}": 2 for i in range(400)} | {"hot": 3_000}
    weights = {s: 1e-5 * (1 + i % 7) for i, s in enumerate(counts)} | {"hot": 1.0}
    frame = spark.createDataFrame([(i, s) for s, n in counts.items() for i in range(n)], "doc_id long, source string")
    got = mixing.mixed(frame, weights, block=1).collect()
    assert len(got) == sum(counts.values())
    assert check_mix(got, counts, weights) > 1000


def true_nearest(ids, x, k, asks):
    out = {}
    for q, v in zip(ids, x):
        if asks(q):
            score = x @ v
            best = sorted((-s, i) for s, i in zip(score, ids) if i != q)[:k]
            out[int(q)] = [int(i) for _, i in best]
    return out


def test_search_recall(spark):
    vectors = table(spark, "/root/testdata/sf0.1", "embeddings")
    frame = vectors.orderBy("vec_id").toPandas()
    x = np.array(frame["embedding"].tolist(), np.float64)
    want = true_nearest(frame["vec_id"].to_numpy(), x, 20, lambda q: q % 20 == 0)
    got = annsearch.nearest(vectors, F.col("vec_id") % 20 == 0).toPandas()
    hits = 0
    for q, g in got.groupby("query_id"):
        g = g.sort_values("rank")
        assert g["rank"].tolist() == list(range(1, 21)) and q not in set(g["vec_id"])
        assert list(zip(-g["score"], g["vec_id"])) == sorted(zip(-g["score"], g["vec_id"]))
        assert np.allclose(g["score"], x[g["vec_id"].to_numpy()] @ x[q], rtol=0, atol=1e-12)
        hits += len(set(g["vec_id"]) & set(want[q]))
    assert set(got["query_id"]) == set(want) and hits >= 0.9 * 20 * len(want)


def test_search_with_copies_and_bad_vectors(spark):
    """A third of the rows share a vector; ties go to the smaller id; one part is exact."""
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(-4, 5, 6).astype(float).tolist(), 1) for i in range(150)]
    rows += [(1000 + i, [1.0, 2.0, 3.0, 1.0, 0.0, 1.0], 1) for i in range(80)]
    bad = [(500, None, 1), (501, [0.0] * 6, 1), (502, [1.0, None] * 3, 1), (503, [float("nan")] * 6, 1), (504, [float("inf")] * 6, 1),
           (505, [], 1), (506, [1.0, 2.0], 1), (None, [1.0] * 6, 1), rows[3]]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, part int").repartition(4)
    good = [r for r in rows if any(r[1])]
    want = true_nearest(np.array([r[0] for r in good]), np.array([r[1] for r in good]), 5, lambda q: q % 2 == 0)
    got = annsearch.nearest(frame, F.col("vec_id") % 2 == 0, k=5, parts=1).orderBy("query_id", "rank").collect()
    found = defaultdict(list)
    for r in got:
        found[r.query_id].append(r.vec_id)
    assert found == want
    assert annsearch.nearest(frame.limit(0), F.col("vec_id") % 2 == 0).count() == 0
    two = annsearch.nearest(frame.where("vec_id in (10, 11)"), F.col("vec_id") % 2 == 0, k=5).collect()
    assert [(r.query_id, r.vec_id, r.rank) for r in two] == [(10, 11, 1)]


def test_partition_is_balanced_and_follows_the_graph():
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((8, 16)) * 4
    x = np.repeat(centres, 100, 0) + rng.standard_normal((800, 16))
    near = annsearch.graph(x, 10)
    label = annsearch.partition(near, 8)
    assert np.bincount(label, minlength=8).tolist() == [100] * 8
    assert (label[near] == label[:, None]).mean() > 0.7
    router, tries = annsearch.fit(x, 8, 10)
    assert 1 <= tries <= 4
