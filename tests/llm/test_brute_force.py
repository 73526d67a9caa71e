"""Operators that SQL cannot express, against plain Python on whole small tables."""

import collections
import functools
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerflow.llm import ctw, fingerprints, packing, queries, tokens

SF = "/root/testdata/sf0.01"
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
split_words = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]


def ids_of(text):
    return TOKENIZER.encode(text, add_special_tokens=False).ids


def test_op2_counts_as_the_library(spark, texts):
    got = queries.op2_token_counts(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        t = texts[r["doc_id"]]
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(t.encode()), len(ids_of(t)), len(ids_of(t)) > 1024)


ODD = [
    "", " ", "  \n\n  x", "don't we'll I'M", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext|", "naïve café",
    "日本語テキスト", "👩‍👩‍👧‍👦 emoji", "x" * 3000, "ab" * 2000 + " 12345", "   wide　space", "١٢٣ ½ Ⅷ", "\x1c\x1d\x85",
    "tab\tnew\r\nline", "ﬁ ſ K", "﻿bom", "é combining", "…—“quotes”",
]


def test_token_counts_and_ids_of_odd_texts():
    bpe = tokens.merges(tokens.vocabulary_path("byte_bpe_50k.json"))
    enc = packing.encoder("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")
    for t in ODD:
        assert bpe.count(t) == len(ids_of(t)), repr(t)
        assert enc.ids(t) == ids_of(t), repr(t)


def test_every_code_point_is_split_as_the_library_does():
    bpe = tokens.merges(tokens.vocabulary_path("byte_bpe_50k.json"))
    enc = packing.encoder("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")
    points = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    probes = [f"a{c} {c}b1{c}{c} 2" for c in points]
    for t, e in zip(probes, TOKENIZER.encode_batch(probes, add_special_tokens=False), strict=True):
        assert enc.ids(t) == e.ids, repr(t)
        assert bpe.count(t) == len(e.ids), repr(t)


def test_op8_packs_whole_documents(spark, texts):
    rows = queries.op8_packing(spark, SF).collect()
    by_doc, by_bin = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_bin[r["sequence_id"]].append(r)
    total = 0
    for d, t in texts.items():
        ids = np.array([*ids_of(t), 2], dtype="<u4")
        total += len(ids)
        own, at = sorted(by_doc[d], key=lambda r: r["piece"]), 0
        assert len(own) == max(1, math.ceil(len(ids) / 1024))
        for k, r in enumerate(own):
            assert (r["piece"], r["start"]) == (k, at)
            assert r["ids_crc32"] == zlib.crc32(ids[at: at + r["length"]].tobytes())
            assert k == 0 or r["length"] == 1024
            at += r["length"]
        assert at == len(ids)
    for own in by_bin.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    assert len(by_bin) <= 1.02 * math.ceil(total / 1024)


@pytest.mark.parametrize("n", [0, 1, 50, 5000, 2_000_000])
def test_packing_plan_places_every_piece_once(n):
    rng = np.random.default_rng(n)
    counts = np.zeros(257, dtype=np.int64)
    counts[1:] = rng.multinomial(n, rng.dirichlet(np.ones(256)))
    slots = packing.plan(counts, 256, most=4096)
    placed = np.zeros_like(counts)
    fill = collections.Counter()
    for length, rank, repeat, first, _ in zip(*(slots[c] for c in ("length", "rank", "repeat", "bin", "offset")), strict=True):
        assert rank == placed[length]
        placed[length] += repeat
        if n <= 5000:
            for b in range(first, first + repeat):
                fill[b] += int(length)
    assert (placed == counts).all()
    assert all(v <= 256 for v in fill.values()) and sorted(fill) == list(range(len(fill)))


def test_op9_edits_and_likeness(spark, texts):
    got = {r["doc_id"]: r for r in queries.op9_fingerprints(spark, SF).collect()}
    order = sorted(texts)
    shingled = lambda t: (lambda w: {tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4))} if w else set())(split_words(t))
    errors = []
    for i, d in enumerate(order):
        t, after = texts[d], texts[order[(i + 1) % len(order)]]
        m = len(t) // 2
        edited = t[: len(t) - m] + after[:m]
        r = got[d]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for s, value in ((edited, r["near_edited"]), (after, r["near_next"])):
            a, b = shingled(t), shingled(s)
            errors.append(abs(value - len(a & b) / max(1, len(a | b))))
            if max(len(a), len(b)) < 128 and a | b:
                assert errors[-1] < 1e-9
    assert np.mean(errors) < 0.015 and max(errors) < 0.2


def test_sketches_merge_and_estimate():
    a = " ".join(f"w{i}" for i in range(3000))
    b = " ".join(f"w{i}" for i in range(1500, 4500))
    whole = fingerprints.sketches([a + " | " + b])[0]
    one, two = fingerprints.sketches([a, b])
    merged = fingerprints.merge(one, two)
    assert len(np.setdiff1d(merged, whole)) <= 2  # but for the shingles across the seam
    assert abs(fingerprints.distinct(one) / 2996 - 1) < 0.3
    assert abs(fingerprints.resemblance(one, two) - 1496 / 4496) < 0.15
    assert abs(fingerprints.containment(one, two) - 1496 / 2996) < 0.2
    assert (fingerprints.decode(fingerprints.encode(one)) == one).all()


def test_op10_base_columns_and_held_out_gain(spark, texts):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    own = {d: [*split_words(t.translate(lower)), None] for d, t in texts.items()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    count = collections.Counter(w for d, ws in own.items() if not held[d] for w in ws)
    n, v = sum(count.values()), len(count)
    rows = queries.op10_context_tree(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ws = own[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[r["doc_id"]], len(ws), n)
        assert r["n_known"] == sum(count[w] > 0 for w in ws)
        assert math.isclose(r["base_score"], sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
    assert 1.5 < np.mean([r["bits_per_byte"] for r in rows if r["held_out"]]) < 4


def test_context_tree_equals_a_slow_recursion(spark, tmp_path):
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("abAB "), 30)) for _ in range(6)] + ["", "zz", "\u00e9 ab"]
    others = ["ab\u00e9a", "quite else", "", "abab ab"]
    docs = spark.createDataFrame(
        [(t, False) for t in texts] + [(t, True) for t in others], "body string, held_out boolean").repartition(3)
    grams = ctw.corpus_counts(docs, most=20).where(f"kind = {ctw.BYTES}")
    model = {r["key"]: r["log_p"] for r in ctw.gram_model(grams, str(tmp_path / "model")).collect()}

    def positions(text):
        data = b"\xff" * 6 + text.encode().lower() + b"\xff"
        return [(data[i], data[i - 6: i]) for i in range(6, len(data))]

    seen = collections.defaultdict(lambda: [0, 0])
    for b, c in (x for t in texts for x in positions(t)):
        for depth in range(7):
            for level in range(8):
                node = (1 << level) | (b >> (8 - level))
                seen[c[6 - depth:], node][(b >> (7 - level)) & 1] += 1
    kt = lambda z, o: math.lgamma(z + .5) + math.lgamma(o + .5) - math.lgamma(z + o + 1) - 2 * math.lgamma(.5)
    children = collections.defaultdict(list)
    for c, node in seen:
        if c:
            children[c[1:], node].append((c, node))

    def below(key):
        return sum(weighted(x) for x in children[key]) if key in children else 0.0

    @functools.cache
    def weighted(key):
        own = kt(*seen[key])
        return own if len(key[0]) == 6 else math.log(.5) + np.logaddexp(own, below(key))

    def chance(c, node, depth=0):
        key = c[6 - depth:], node
        z, o = seen.get(key, (0, 0))
        own = (o + .5) / (z + o + 1)
        if depth == 6 or (c[5 - depth:], node) not in seen:
            return own
        w = 1 / (1 + math.exp(below(key) - kt(z, o)))
        return w * own + (1 - w) * chance(c, node, depth + 1)

    asked = {(b, c) for t in texts + others for b, c in positions(t)}
    assert len(model) == len(asked)
    for b, c in asked:
        p = 1.0
        for level in range(8):
            one = chance(c, (1 << level) | (b >> (8 - level)))
            p *= one if (b >> (7 - level)) & 1 else 1 - one
        assert math.isclose(model[int.from_bytes(c) << 8 | b], math.log10(p), rel_tol=1e-9, abs_tol=1e-12)
    for c in {c for _, c in asked}:  # decisions are even or better known, but always sum to one
        assert math.isclose(sum(math.prod(
            (one if (b >> (7 - level)) & 1 else 1 - one) for level in range(8)
            for one in [chance(c, (1 << level) | (b >> (8 - level)))]) for b in range(256)), 1, rel_tol=1e-9)
        break


def test_op10_tables_of_any_size_give_the_same_scores(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    large = {r["doc_id"]: (r["n_known"], r["score"]) for r in ctw.score(docs).collect()}
    small = {r["doc_id"]: (r["n_known"], r["score"]) for r in ctw.score(docs, max_grams=300, max_hot=9).collect()}
    assert large.keys() == small.keys()
    for d in large:
        assert large[d][0] == small[d][0]
        assert math.isclose(large[d][1], small[d][1], rel_tol=1e-9)


def test_op10_beats_the_unigram_on_held_out_texts(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.op10_context_tree(spark, sf).where("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_op3_finds_held_out_toxic_documents(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = queries.op3_toxicity(spark, sf).where("held_out").join(labels, "doc_id").collect()
    hit = sum(r["predicted"] == 1 and r["toxic"] == 1 for r in rows)
    false = sum(r["predicted"] == 1 and r["toxic"] == 0 for r in rows)
    assert hit >= 0.8 * sum(r["toxic"] for r in rows)
    assert false <= 0.005 * len(rows)


def test_pipeline_stages_against_plain_python(spark, tmp_path):
    import corpus_pipeline as cp
    from ledgerflow.llm.secret_ledger import RULES

    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), []
    for i, (name, stage) in enumerate(cp.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        seen.append([r.asDict() for r in docs.collect()])
        assert i == len(cp.STAGES) - 1 or set(docs.columns) == {"doc_id", "text", "lang", "source", "n_chars"}
    safe, single, clean, mixed, packed = seen
    # Near duplicates: the rows that stay are the least ids of the links' components.
    grams = {}
    for r in safe:
        w = split_words(r["text"])
        grams[r["doc_id"]] = {tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    label = {d: d for d in grams}
    where = collections.defaultdict(list)
    for d, g in grams.items():
        for x in g:
            where[x].append(d)
    linked = [(a, b) for a, b in {(a, b) for ds in where.values() for a in ds for b in ds if a < b}
              if 5 * len(grams[a] & grams[b]) >= 4 * len(grams[a] | grams[b])]
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    assert {r["doc_id"] for r in single} == {d for d in label if label[d] == d}
    # Secrets: no rule finds anything in what is left, and nothing but secrets changed.
    before = {r["doc_id"]: r["text"] for r in single}
    assert len(clean) == len(single)
    patterns = [(re.compile(r.pattern if r.kind != "assign" else r"(password|passwd|secret|token|api_?key)" + r.pattern.split(")", 2)[2], re.I if r.kind == "assign" else 0), r) for r in RULES]
    for r in clean:
        assert r["n_chars"] == len(r["text"])
        assert (r["text"] == before[r["doc_id"]]) == ("[secret]" not in r["text"])
        for p, rule in patterns:
            assert not any(len(m[rule.group]) >= rule.least for m in p.finditer(r["text"]))
    # Mixing keeps every document and repeats none more than twice over.
    times = collections.Counter(r["doc_id"] for r in mixed)
    assert set(times) == {r["doc_id"] for r in clean} and max(times.values()) <= 3
    # Packing: every row of the mix, whole.
    lengths = collections.Counter()
    for r in packed:
        lengths[r["doc_id"]] += r["length"]
    texts = {r["doc_id"]: r["text"] for r in clean}
    assert lengths == {d: n * (len(ids_of(texts[d])) + 1) for d, n in times.items()}
