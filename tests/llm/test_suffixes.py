"""Repeated byte strings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from featmart.llm import suffixes


def brute(texts, length):
    """(n_bytes, n_removed, n_spans, kept) of each text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(d)) if gone[i] and not (i and gone[i - 1]))
        out.append((len(d), sum(gone), spans, bytes(b for b, g in zip(d, gone) if not g)))
    return out


def found(spark, texts, length, **kwargs):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    rows = suffixes.remove_repeats(frame, length=length, **kwargs).collect()
    return [(r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), bytes(r["kept"])) for r in sorted(rows, key=lambda r: r["doc_id"])]


def passages(seed, n, alphabet, copies, size):
    """Texts of random letters with passages in common that are cut and changed at places."""
    rng = random.Random(seed)
    make = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    shared = [make(rng.randint(size // 2, 4 * size)) for _ in range(copies)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            part = rng.choice(shared)
            cut = rng.randint(0, len(part))
            parts += [make(rng.randint(0, size)), part[cut // 2 :] if rng.random() < 0.5 else part[:cut] + rng.choice(alphabet) + part[cut + 1 :]]
        texts.append("".join(parts))
    return texts


@pytest.mark.parametrize("length, alphabet, per_range", [(20, "ab", 50), (20, "abcdefghij é", 10), (7, "ab", 40), (200, "abcdefghij ", 5), (200, "abcdefghij ", 16_384), (1, "abc", 3)])
def test_removed_bytes_are_those_of_brute_force(spark, length, alphabet, per_range):
    texts = [*passages(length, 60, alphabet, 6, max(4, length)), None, "", "a" * (5 * length), "a" * length, "ab" * 3 * length, "x\0" * length, "x" + "\0" * length]
    assert found(spark, texts, length, per_range=per_range, filter_bits=16) == brute(texts, length)


def test_a_token_in_very_many_contexts_goes_round_again(spark):
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(330))
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(150, 260))) + passage + "".join(rng.choice("abcdefgh ") for _ in range(150)) for _ in range(150)]
    assert found(spark, texts, 200, per_range=20, filter_bits=16) == brute(texts, 200)


def test_whole_table_and_long_texts(spark, docs, rows, registered, monkeypatch):
    got = {r["doc_id"]: tuple(r)[1:] for r in registered["op11_suffix_dedup"].run(spark, "/root/testdata/sf0.001").collect()}
    want = {r[0]: (n, removed, spans, hashlib.sha256(kept).hexdigest()) for r, (n, removed, spans, kept) in zip(rows, brute([r[1] for r in rows], 200))}
    assert got == want and len(got) == docs.count()


def test_stretches_of_long_texts(monkeypatch):
    monkeypatch.setattr(suffixes, "SEGMENT_BYTES", 300)
    sizes = [0, 50, 900, 20, 300, 301, 0, 199, 5000, 220]
    offsets = np.cumsum([0, *sizes])
    windows = [w for begin, end, ws in suffixes.segments(offsets, 20) for w in ws if begin <= w[1] and w[2] + 19 <= end]
    starts = sorted((i, s - int(offsets[i])) for i, a, b in windows for s in range(a, b))
    assert starts == [(i, s) for i, n in enumerate(sizes) for s in range(n - 19)]


def test_odd_rows(spark, odd, none):
    out = suffixes.remove_repeats(odd).collect()
    assert len(out) == odd.count()
    by_id = Counter(r["doc_id"] for r in out)
    assert by_id[2] == 2 and by_id[None] == 2
    want = Counter(brute([r["text"] for r in odd.collect()], 200))
    assert Counter((r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), bytes(r["kept"])) for r in out) == want
    assert suffixes.remove_repeats(none).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=40), max_size=120))
def test_multikey_quicksort_orders_bytes(rows):
    assert [rows[i] for i in suffixes.multikey_quicksort(rows)] == sorted(rows)


def test_multikey_quicksort_on_common_beginnings():
    rng = random.Random(1)
    rows = [b"same beginning " * rng.randint(0, 3) + bytes(rng.choices(b"ab\0", k=rng.randint(0, 30))) for _ in range(3000)]
    assert [rows[i] for i in suffixes.multikey_quicksort(rows)] == sorted(rows)
