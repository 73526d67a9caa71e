"""Rank-queue encoding, tokenizer alignment and bit-plane clustering against libraries and plain Python."""

import base64
import collections
import hashlib
import struct

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from ledgerflow.llm import alignment, bit_planes, queries, rank_queue

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
ODD = [
    "", " ", "  \n\n  x ", "don't we'll I'M", "<|endoftext|> <s> </s> <unk> <0x41>", "naïve café", "日本語テキスト", "👩‍👩‍👧‍👦 emoji",
    "x" * 3000, "ab" * 2000 + " 12345", "   wide　space ", "١٢٣ ½ Ⅷ", "\x00\x1c\x1d\x85", "tab\tnew\r\nline", "▁piece", "a▁b c", "ﬁ ſ K é",
    "a " * 300, "   b  c" * 50, " " * 5000 + "end", "x \n \n y",
]


# ------------------------------------------------------------------ rank queue

@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_queue_gives_lowest_rank_then_leftmost():
    rng = np.random.default_rng(3)
    queue, held = rank_queue.RankQueue(50_000), set()
    for _ in range(3000):
        if rng.random() < 0.6 or not held:
            item = (int(rng.choice([rng.integers(5), rng.integers(50_000)])), int(rng.integers(10**6)))
            if item not in held:
                held.add(item)
                queue.put(*item)
        else:
            assert queue.pop() == min(held)
            held.remove(min(held))
    while held:
        assert queue.pop() == min(held)
        held.remove(min(held))
    assert queue.pop() is None and not any(queue.low) and not queue.top


def test_ids_are_the_librarys(library):
    bpe = rank_queue.coder("byte_bpe_multi_50k.tiktoken")
    rng = np.random.default_rng(1)
    made = ["".join(rng.choice(list(a), n)) for a in ("ab", "a", "abcde ", "日本語", "etaoin") for n in (1, 2, 3, 17, 400, 20_000)]
    for t in ODD + made:
        packed = bpe.encode(t)
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == library.encode_ordinary(t), repr(t[:40])
        assert bpe.decode(packed) == t.encode()


def test_forgetting_does_not_change_ids(library):
    bpe = rank_queue.Coder(rank_queue.coder("byte_bpe_multi_50k.tiktoken").ranks, public_tokenizers.PATTERN, remember=4, longest=6)
    for t in [f"one two three{i} four five-and-twenty {i * i}" for i in range(30)] * 2:
        assert np.frombuffer(bpe.encode(t), "<u4").tolist() == library.encode_ordinary(t)
        assert len(bpe) <= 4 and len(bpe.older) <= 4


def test_op11_round_trip(spark, texts, library):
    rows = queries.op11_rank_queue(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = np.array(library.encode_ordinary(texts[r["doc_id"]]), dtype="<u4")
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_coding_edges(make_docs):
    docs = make_docs([(1, "one two"), (2, None), (3, ""), (None, "x"), (4, "one two"), (4, "one two"), (5, "y" * 100_000)])
    rows = rank_queue.decode(rank_queue.encode(docs)).collect()
    assert sorted(bytes(r["decoded"]) for r in rows) == sorted((r["text"] or "").encode() for r in rows) and len(rows) == 7
    assert all(r["ids"] == b"" for r in rows if not r["text"])
    same = lambda df: sorted((r["doc_id"] or 0, bytes(r["ids"]), bytes(r["decoded"])) for r in df.collect())
    assert same(rank_queue.round_trip(docs)) == same(rank_queue.decode(rank_queue.encode(docs)))
    assert rank_queue.encode(docs.where("doc_id > 99")).count() == 0 and rank_queue.round_trip(docs.where("doc_id > 99")).count() == 0
    assert rank_queue.decode(docs.selectExpr("cast(null as binary) as ids").limit(1)).first()["decoded"] == b""
    with pytest.raises(ValueError):
        rank_queue.encode(docs.withColumnRenamed("extra", "ids"))
    with pytest.raises(ValueError):
        rank_queue.decode(docs.withColumnRenamed("extra", "decoded"), ids="text")


# ------------------------------------------------------------------ alignment

@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    known = alignment.vocabularies("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model")
    decode = {c: bytes([i]) for i, c in enumerate(alignment._byte_letters())}
    names = {i: t for t, i in a.get_vocab().items()}
    a_bytes = lambda i: b"".join(decode[c] for c in names[i])
    b_bytes = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    assert known.a_bytes[:50256] == [a_bytes(i) for i in range(50256)]

    def slow(text):
        """Token ids, groups and links (as index pairs) of one text, whole texts through the libraries."""
        ids_a, ids_b = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        raw = (" " + text).encode() if text else b""
        own_a, own_b = [a_bytes(i) for i in ids_a], [b_bytes(i) for i in ids_b]
        if b"".join(own_a) != raw or b"".join(own_b) != raw:
            return [], [], [], []
        ranges = []
        for own in (own_a, own_b):
            ends = np.cumsum([len(x) for x in own]).tolist()
            ranges.append(list(zip([0, *ends[:-1]], ends)))
        cuts = sorted({e for _, e in ranges[0]} & {e for _, e in ranges[1]})
        groups, links, i, j = [], [], 0, 0
        for cut in cuts:
            i0, j0 = i, j
            while i < len(ids_a) and ranges[0][i][1] <= cut:
                i += 1
            while j < len(ids_b) and ranges[1][j][1] <= cut:
                j += 1
            groups.append((ids_a[i0:i], ids_b[j0:j]))
            links += [(x, y) for x in range(i0, i) for y in range(j0, j)
                      if ranges[0][x][0] < ranges[1][y][1] and ranges[1][y][0] < ranges[0][x][1]]
        return ids_a, ids_b, groups, links

    return slow


def expected(slow, rows):
    found = {k: slow(t or "") for k, t in rows.items()}
    count = collections.Counter((f[0][x], f[1][y]) for f in found.values() for x, y in f[3])
    best = collections.defaultdict(int)
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    out = {}
    for k, (ids_a, ids_b, groups, links) in found.items():
        pairs = [(ids_a[x], ids_b[y]) for x, y in links]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out[k] = (len(ids_a), len(ids_b), len(groups), len(links), sum(count[p] == best[p[1]] for p in pairs), sum(count[p] for p in pairs),
                  hashlib.sha256(text.encode()).hexdigest() if ids_a else "")
    return out


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("max_hot", [1 << 18, 5, 0])
def test_alignment_of_odd_texts(make_docs, both, max_hot):
    rows = dict(enumerate([*ODD, None, "same text twice", "same text twice"]))
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in alignment.report(make_docs(list(rows.items())), max_hot=max_hot).collect()}
    assert got == expected(both, rows)
    assert got[ODD.index("▁piece")] == (0, 0, 0, 0, 0, 0, "")


def test_op12_on_whole_documents(spark, both):
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in queries.op12_alignment(spark, SMALL).collect()}
    assert got == expected(both, rows)


def test_alignment_edges(make_docs):
    docs = make_docs([(None, "x y"), (7, "x y"), (7, "x y")])
    rows = alignment.report(docs, keep_groups=True).collect()
    assert len(rows) == 3 and len({tuple(r[c] for c in COLUMNS) for r in rows}) == 1 and {r["doc_id"] for r in rows} == {None, 7}
    assert rows[0]["count_sum"] == 3 * rows[0]["n_links"] and rows[0]["groups"].count(";") == rows[0]["n_groups"] - 1
    assert alignment.report(docs.where("doc_id > 99")).count() == 0


def test_shared_cuts_are_all_found():
    rng = np.random.default_rng(5)
    for n in (1, 2, 30, 3000):
        for share in (0.0, 0.01, 0.5, 1.0):
            ends_b = np.unique(np.append(rng.integers(1, 10 * n, n), 10 * n))
            own = np.setdiff1d(rng.integers(1, 10 * n, n), ends_b)
            ends_a = np.unique(np.concatenate((own, ends_b[rng.random(len(ends_b)) < share], [10 * n])))
            first = alignment.shared_cuts(ends_a, ends_b, np.array([0]), np.array([len(ends_a)]))
            assert ends_a[np.append(first[1:], len(ends_a)) - 1].tolist() == np.intersect1d(ends_a, ends_b).tolist() and first[0] == 0


def test_every_code_point_is_encoded_as_the_library_does():
    known = alignment.vocabularies("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model")
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for lo in range(0, len(points), 5000):
        probe = "\n".join(f"a{c} {c}b1{c}{c} 2" for c in points[lo: lo + 5000])
        assert known.ids_a(probe) == known.exact.encode(probe, add_special_tokens=False).ids, hex(lo)


def test_long_white_space_goes_to_the_own_library(make_docs):
    got = alignment.report(make_docs([(1, "a" + "\n" * 1_200_000 + "b")], parts=1)).first()
    assert got["n_b"] > 1_200_000 and got["n_links"] >= got["n_b"] and got["count_sum"] > got["n_links"]


# ------------------------------------------------------------------ bit planes

def test_dot_products_are_exact():
    rng = np.random.default_rng(0)
    for most in (1, 3, 200, 1 << 20, (1 << 27) - 1):
        x, c = rng.integers(-most, most + 1, (300, 64)), rng.integers(-most, most + 1, (7, 64))
        width = most.bit_length() + 1
        planes = bit_planes.pack_planes(x, width)
        assert (bit_planes.unpack_planes(planes) == x).all()
        assert (bit_planes.dots(planes, bit_planes.pack_planes(c, width)) == x @ c.T).all()
        label, distance = bit_planes.nearest(planes, (x * x).sum(axis=1), c)
        true = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        assert (label == true.argmin(axis=1)).all() and (distance == true.min(axis=1)).all()


def plain(rows, k=40, rounds=5):
    """rows of (vec_id, vector) -> rows of the query, in Python integers."""
    good = [(i, [int(np.floor(256 * float(e))) for e in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(e is not None and np.isfinite(e) for e in v)]
    hashed = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    centres = [v for _, v in sorted(good, key=lambda r: (hashed(r[0]), r[1]))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        own = collections.defaultdict(list)
        for _, v in good:
            own[near(v)[1]].append(v)
        centres = [[sum(x) // len(x) for x in zip(*own[j])] if own[j] else c for j, c in enumerate(centres)]
    last = [(i, *near(v)[::-1]) for i, v in good]
    inertia = collections.Counter()
    for _, j, d in last:
        inertia[j] += d
    text = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return collections.Counter((i, j, d, inertia[j], sum(inertia.values()), text[j]) for i, j, d in last)


def clusters(df):
    got = df.withColumn("h", bit_planes.centroid_digest()).collect()
    return collections.Counter((r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["h"]) for r in got)


def test_clusters_of_odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=64).round(3).tolist()) for i in range(120)]
    rows += [(3, rows[5][1]), (3, rows[5][1]), (None, rows[0][1]), (500, None), (501, []), (502, [1.0] * 63), (503, [1.0] * 65)]
    rows += [(504, [1.0] * 63 + [None]), (505, [float("nan")] + [0.0] * 63), (506, [float("-inf")] + [0.0] * 63), (507, [0.0] * 64), (508, [-0.0] * 64)]
    rows += [(600 + i, [1.0 / 256] * 64) for i in range(60)] + [(700, [1000.5] * 64)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, cluster string, norm int").repartition(5)
    assert clusters(bit_planes.cluster(df)) == plain(rows)
    assert clusters(bit_planes.cluster(df, k=200)) == plain(rows, k=200)
    assert bit_planes.cluster(df.where("vec_id > 9999")).collect() == [] and bit_planes.cluster(df.where("vec_id = 500")).count() == 0
    with pytest.raises(ValueError):
        bit_planes.cluster(df.unionByName(spark.createDataFrame([(1, [1e9] * 64, "", 0)], df.schema)))


def test_op13_on_the_whole_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    got = queries.op13_bit_planes(spark, SMALL).collect()
    assert collections.Counter((r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in got) == plain(rows)
