"""Mixing, fingerprints, language model, packing and the pipeline against brute force."""

import base64
import binascii
import hashlib
import math
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from featmart.llm import exact, langid, lm, mixing, packing, queries, simhash, syncmers
from tests.llm.conftest import LONG, SF

WHITE = " \t\n\x0b\x0c\r"


def words_of(text):
    return "".join(" " if c in WHITE else c for c in text or "").split(" ") and [w for w in "".join(" " if c in WHITE else c for c in text or "").split(" ") if w]


# Mixing


def plain_targets(sizes, share=1.5, repeats=2):
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    capped = set()
    while True:
        left = share * sum(sizes) - sum(repeats * sizes[i] for i in capped)
        weight = sum(weights[i] for i in range(len(sizes)) if i not in capped)
        out = [repeats * s if i in capped else left * weights[i] / weight for i, s in enumerate(sizes)]
        over = {i for i, s in enumerate(sizes) if i not in capped and out[i] > repeats * s}
        if not over:
            return out
        capped |= over


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_mix(request, which):
    df = request.getfixturevalue(which)
    block = 64 if which == "docs" else 4
    data = [(r["doc_id"], len(words_of(r["text"])), r["source"]) for r in df.collect()]
    totals = defaultdict(int)
    for _, n, s in data:
        totals[s] += n
    names = sorted(totals, key=lambda s: (s is None, s or ""))
    want = dict(zip(names, plain_targets([totals[s] for s in names])))
    rows = mixing.taken_words(mixing.mix(df, block_words=block)).collect()
    assert Counter((r["doc_id"], r["size"], r["source"]) for r in rows) == Counter(data)
    taken = defaultdict(int)
    for r in rows:
        assert r["source_size"] == totals[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in names:
        assert abs(taken[s] - want[s]) <= 5 * block
    again = mixing.taken_words(mixing.mix(df.repartition(3), block_words=block)).collect()
    assert Counter((r["doc_id"], r["size"], r["taken"]) for r in again) == Counter((r["doc_id"], r["size"], r["taken"]) for r in rows)


def test_schedule_is_even_everywhere(spark, docs):
    mixed = mixing.mix(docs)
    plan = mixed.plan
    slots = mixing.schedule(spark, plan, 64).orderBy("slot").collect()
    assert [r["slot"] for r in slots] == list(range(round(sum(plan.targets) / 64)))
    seen, share = Counter(), [t / sum(plan.targets) for t in plan.targets]
    for i, r in enumerate(slots, 1):
        assert r["rank"] == seen[r["_fl_index"]]
        seen[r["_fl_index"]] += 1
        assert all(abs(seen[s] - i * p) < 6 for s, p in enumerate(share))


def test_pieces_cover_blocks_once_per_slot(docs):
    pieces = mixing.mix(docs).pieces.groupBy("slot").agg({"words": "sum", "place": "min"}).collect()
    assert all(r["min(place)"] == 0 and 0 < r["sum(words)"] <= 64 for r in pieces)
    assert sum(r["sum(words)"] == 64 for r in pieces) > 0.8 * len(pieces)


def test_short_sources_reach_their_targets(spark):
    """Sources far shorter than a block, and of a block and a bit, beside large ones."""
    sizes = {f"big{i}": 8000 for i in range(3)}
    sizes |= {f"s{n:04}_{i:03}": n for n in (1, 10, 30, 65, 100, 1000) for i in range(20)}
    data = []
    for s, n in sizes.items():
        step = max(1, n // 5)
        data += [(len(data) + j, "w " * min(step, n - at), s) for j, at in enumerate(range(0, n, step))]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    mixed = mixing.mix(df, block_words=64)
    taken, want = Counter(), {}
    for r in mixing.taken_words(mixed).collect():
        taken[r["source"]] += r["taken"]
        want[r["source"]] = r["target"]
        assert r["taken"] <= 2 * r["size"]
    assert any(t == 20 for t in want.values())
    assert all(taken[s] == round(t) for s, t in want.items())
    # No part of the row is without the short sources that the schedule leaves out.
    added = [r["at"] for r in mixed.pieces.where("source like 's0010%'").collect()]
    slots = mixing.slot_count(mixed.plan, 64)
    assert all(any(slots * k / 4 <= at < slots * (k + 1) / 4 for at in added) for k in range(4))
    copies = Counter(r["source"] for r in mixing.mixed_documents(df, block_words=64).collect())
    assert all(copies[s] for s in sizes if want[s] >= sizes[s])


def test_mixed_documents(docs, odd, none):
    for df, block in ((docs, 64), (odd, 4)):
        out = mixing.mixed_documents(df, block_words=block)
        assert out.columns == df.columns
        have, was = Counter(map(str, out.collect())), Counter(map(str, df.collect()))
        assert set(have) <= set(was) and all(have[k] <= 2 * was[k] for k in have)
    assert mixing.mixed_documents(none).collect() == [] and mixing.taken_words(mixing.mix(none)).collect() == []
    with pytest.raises(ValueError):
        mixing.mix(docs, max_sources=3)


# Fingerprints


UNSPACED = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}"


def units_of(text):
    return regex.findall(rf"[{UNSPACED}]|[^\x20\x09-\x0D{UNSPACED}]{{1,4}}", text)


def spark_hashes(spark, values):
    """xxhash64 of several longs in a row, as Spark has it."""
    df = spark.createDataFrame([(list(v),) for v in values], "v array<bigint>")
    return {tuple(r["v"]): r["h"] for r in df.select("v", F.xxhash64("v").alias("h")).collect()}


def plain_anchors(spark, texts, k, s):
    """(place, hash) of the closed syncmers of each text, by their definition, or of all units where there is none."""
    parts = [units_of(t) for t in texts]
    words = sorted({u for p in parts for u in p})
    key = {r["w"]: r["h"] for r in spark.createDataFrame([(w,) for w in words], "w string").select("w", F.xxhash64("w").alias("h")).collect()}
    hashed = [[key[u] for u in p] for p in parts]
    runs = {tuple(h[i : i + n]) for h in hashed for n in (s, k) for i in range(len(h) - n + 1)}
    mers = spark_hashes(spark, runs)
    whole = {r["t"]: r["h"] for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.xxhash64(syncmers.units(F.col("t"))).alias("h")).collect()}
    out = []
    for text, h in zip(texts, hashed):
        found = []
        for i in range(len(h) - k + 1):
            inner = [mers[tuple(h[j : j + s])] for j in range(i, i + k - s + 1)]
            if min(inner) in (inner[0], inner[-1]):
                found.append((i, mers[tuple(h[i : i + k])] & 0xFFFFFF))
        out.append(found or ([(0, whole[text] & 0xFFFFFF)] if h else []))
    return out


def unpacked(text):
    """(place, hash) of each anchor of a fingerprint."""
    data, at, out = base64.b64decode(text), 0, []
    for i in range(0, len(data), 4):
        at += data[i + 3]
        out.append((at, int.from_bytes(data[i : i + 3], "big")))
    return out


def plain_likeness(a, b):
    if not a and not b or a == b:
        return 1.0
    sided = sorted([(h, 0, at) for at, h in a] + [(h, 1, at) for at, h in b])
    steps = Counter(y[2] - x[2] for x, y in zip(sided, sided[1:]) if x[0] == y[0] and x[1] < y[1])
    if not steps:
        return 0.0
    offset = min(steps, key=lambda d: (-steps[d], d))
    return 2 * len(set(a) & {(at - offset, h) for at, h in b}) / (len(a) + len(b))


LETTERS = [*"abcdefghijklmnopqrstuvwxyz"]


def random_texts(rng, n, words):
    return [" ".join("".join(rng.choice(LETTERS, rng.integers(1, 12))) for _ in range(rng.integers(0, words))) for _ in range(n)]


@pytest.mark.parametrize("k, s", [(syncmers.K, syncmers.S), (6, 3)])
def test_anchors_against_definition(spark, k, s):
    rng = np.random.default_rng(6)
    texts = ["a b c d e f g h i j k l m n o p q r s t u v w x y z " * 3, "a b", "", " lead and trail \n", "x y z " * 30, "één twee drie vier vijf", "漢字かなกขค abcdefghij漢漢", "x" * 500, "\U0001f600" * 9]
    texts += random_texts(rng, 30, 60)
    found = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", syncmers.as_text(syncmers.anchors(F.col("t"), k, s)).alias("a")).collect()
    want = plain_anchors(spark, texts, k, s)
    for r in found:
        assert unpacked(r["a"]) == want[r["i"]], texts[r["i"]]


def test_units_of_all_characters_without_looking_up_scripts_below_them(spark):
    """The units are those of the plain definition for every code point, and plain text is cut in well under its time."""
    plain = F.regexp_extract_all(F.col("t"), F.lit(rf"[{syncmers.UNSPACED}]|[^{syncmers.WHITE}{syncmers.UNSPACED}]{{1,4}}"), F.lit(0))
    found = syncmers.units(F.col("t"))
    points = spark.range(0x110000).where(~F.col("id").between(0xD800, 0xDFFF))
    c = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    texts = points.select("id", F.concat(c, F.lit("a"), F.repeat(c, 6), F.lit("b")).alias("t"))
    assert texts.where(F.size(found) > 0).count() == 0x110000 - 0x800
    assert [r["id"] for r in texts.where(found != plain).limit(5).collect()] == []

    long = spark.range(0, 400, 1, 4).select(F.repeat(F.concat(F.lit("Plain words, été "), F.col("id").cast("string")), 400).alias("t")).cache()
    long.count()

    def seconds(units):
        start = time.perf_counter()
        long.select(units.alias("u")).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    pairs = [(seconds(found), seconds(plain)) for _ in range(5)]
    long.unpersist()
    assert min(a for a, _ in pairs) < 0.75 * min(b for _, b in pairs), pairs


def test_anchors_of_an_edited_text_are_those_of_the_whole(spark):
    rng = np.random.default_rng(7)
    parts = ["", " ", "a", "ab ", "abcd", "word words ", "漢", "\n\t", "abcdefgh", "é"]
    rows = []
    for i in range(600):
        prefix, rest, tail = ("".join(rng.choice(parts, rng.integers(0, n))) for n in (40, 15, 15))
        rows.append((i, prefix, prefix + rest, tail))
    df = spark.createDataFrame(rows, "i int, prefix string, text string, tail string")
    edited = syncmers.edited_anchors(syncmers.anchors(F.col("text")), F.col("prefix"), F.col("tail"))
    wrong = df.select("prefix", "text", "tail", edited.alias("a"), syncmers.anchors(F.concat("prefix", "tail")).alias("b")).where("a <> b").collect()
    assert not wrong, wrong[:2]


def test_passages_count_by_their_place(spark):
    """Moved, swapped and repeated passages score below the same passages in place; an insertion in front moves all anchors alike."""
    rng = np.random.default_rng(8)
    a, b, c = (" ".join("".join(rng.choice(LETTERS, rng.integers(2, 9))) for _ in range(80)) + " " for _ in range(3))
    pairs = {"same": (a + b, a + b), "changed end": (a + b, a + c), "swapped": (a + b, b + a), "repeated": (a + b, a + a), "inserted": (a + b, "one two three " + a + b), "other": (a, c), "twice": (a + a + b, a + a + b)}
    df = spark.createDataFrame([(k, x, y) for k, (x, y) in pairs.items()], "k string, x string, y string")
    got = {r["k"]: r["n"] for r in df.select("k", syncmers.likeness(syncmers.anchors(F.col("x")), syncmers.anchors(F.col("y"))).alias("n")).collect()}
    assert got["same"] == got["twice"] == 1.0 and got["other"] == 0.0
    assert got["inserted"] > 0.9 and 0.4 < got["changed end"] < 0.6
    assert got["swapped"] < 0.6 and got["repeated"] < 0.6


def test_short_and_unspaced_texts_have_anchors(spark):
    """Unrelated texts of every length are told apart, and those of some twenty words or more that keep three quarters stay alike."""
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(LETTERS, rng.integers(3, 9)))
    chars = lambda first, n: "".join(chr(first + c) for c in rng.integers(0, 40, n))
    kinds = {f"{n} words": [" ".join(word() for _ in range(n)) for _ in range(40)] for n in (2, 5, 8, 12, 20, 30)}
    kinds |= {"han": [chars(0x4E00, 200) for _ in range(40)], "thai": [chars(0x0E01, 200) for _ in range(40)], "no space": [chars(0x61, 300) for _ in range(40)]}
    kinds["han in lines"] = [" ".join(chars(0x4E00, 20) for _ in range(10)) for _ in range(40)]
    data = [(i, k, t) for i, (k, t) in enumerate((k, t) for k, texts in kinds.items() for t in texts)]
    df = spark.createDataFrame(data, "doc_id long, kind string, text string")
    rows = syncmers.fingerprint_edits(df).join(df.select("doc_id", "kind"), "doc_id").collect()
    assert all(r["fingerprint"] and r["edited_fingerprint"] for r in rows)
    assert len({r["fingerprint"] for r in rows}) == len(rows)
    by_kind = {k: [(r["near_edited"], r["near_next"]) for r in rows if r["kind"] == k] for k in kinds}
    means = {k: tuple(np.mean(v, axis=0)) for k, v in by_kind.items()}
    assert all(next_ < 0.05 for _, next_ in means.values()), means
    assert all(near > 0.5 for k, (near, _) in means.items() if k not in ("2 words", "5 words", "8 words", "12 words")), means


@pytest.mark.parametrize("which", ["docs", "odd"])
@pytest.mark.parametrize("partitions", ["4", "40"])
def test_edited_texts(spark, request, which, partitions):
    df = request.getfixturevalue(which)
    data = sorted(((r["doc_id"], r["text"] or "") for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        rows = syncmers.fingerprint_edits(df).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = []
    for (i, text), (_, following) in zip(data, data[1:] + data[:1]):
        q = len(text) // 4
        want.append((i, len(text), hashlib.sha256((text[: len(text) - q] + following[:q]).encode()).hexdigest()))
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows) == Counter(want)
    prints = defaultdict(set)
    texts = defaultdict(set)
    for i, t in data:
        texts[i].add(t)
    for r in rows:
        if len(texts[r["doc_id"]]) == 1:
            prints[next(iter(texts[r["doc_id"]]))].add(r["fingerprint"])
        assert r["near_edited"] == pytest.approx(plain_likeness(unpacked(r["fingerprint"]), unpacked(r["edited_fingerprint"])))
    assert all(len(p) == 1 for p in prints.values())
    if which == "docs":
        near = sorted(r["near_edited"] for r in rows)
        assert np.mean(near) > 0.6 and np.mean([r["near_next"] for r in rows]) < 0.1
        assert sum(len(r["fingerprint"]) for r in rows) < sum(len(t) for _, t in data) / 2


# Language model


def plain_scores(data, held):
    train = [words_of(lower(t)) for (i, t), h in zip(data, held) if not h]
    c, pair, start = Counter(), Counter(), len(train)
    for words in train:
        c.update([*words, None])
        pair.update(zip(["<start>", *words], [*words, None]))
    n, v = sum(c.values()), len(c)
    context = lambda h: start if h == "<start>" else c[h]
    bins = defaultdict(list)
    for (h, w), k in pair.items():
        alone = c[w] / (n + v)
        ratio = (k - 1) / (context(h) - 1) / alone if k > 1 and context(h) > 1 else 0.0
        bins[int(math.log2(context(h)))].append((ratio, k))
    weight = {}
    for b, items in bins.items():
        ratio, k = (np.array(x, float) for x in zip(*items))
        with np.errstate(divide="ignore"):
            ratio = np.where(ratio > 0, 2.0 ** (np.rint(16 * np.log2(ratio)) / 16), 0.0)
        weight[b] = lm.learn_weight(ratio, k)
    out = []
    for (i, t), h in zip(data, held):
        words = words_of(lower(t))
        base = score = known = 0
        for h_, w in zip(["<start>", *words], [*words, None]):
            alone = (c[w] + 1) / (n + v + 1)
            a = weight.get(int(math.log2(context(h_))), 0.0) if context(h_) else 0.0
            p = a * pair[h_, w] / context(h_) if a else 0.0
            base += math.log10(alone)
            score += math.log10(p + (1 - a) * alone)
            known += c[w] > 0
        out.append((i, h, len(words) + 1, known, n, round(base, 6), round(score, 6)))
    return out


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("frequent", [lm.FREQUENT, 40])
@pytest.mark.parametrize("which", ["docs", "odd"])
def test_scores_against_brute_force(request, which, frequent, monkeypatch):
    """With few frequent words all four kinds of pairs occur."""
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    monkeypatch.setattr(lm, "START", frequent)
    df = request.getfixturevalue(which)
    data = [(r["doc_id"], r["text"]) for r in df.collect()]
    held = [binascii.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in data]
    rows = lm.score_documents(df, langid.fold("doc_id", 7) == 2).collect()
    got = [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6)) for r in rows]
    for g, w in zip(sorted(got, key=repr), sorted(plain_scores(data, held), key=repr), strict=True):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], abs=1e-4)


def test_probabilities_add_up():
    ratio, n = np.array([0.0, 2.0, 50.0]), np.array([10.0, 5.0, 5.0])
    weight = lm.learn_weight(ratio, n)
    best = max(np.linspace(0.0001, 0.9999, 9999), key=lambda a: (n * np.log(a * ratio + 1 - a)).sum())
    assert weight == pytest.approx(best, abs=2e-3)


def test_scores_without_training(none, odd):
    from pyspark.sql import functions as F

    assert lm.score_documents(none, F.lit(False)).collect() == []
    rows = lm.score_documents(odd, F.lit(True)).collect()
    assert len(rows) == odd.count() and all(r["n_known"] == 0 and r["score"] == r["base_score"] == 0.0 for r in rows)


# Packing


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_packing_round_trip(request, which):
    df = request.getfixturevalue(which)
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    want = Counter()
    for r in df.collect():
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            piece = ids[k : k + 4096]
            want[r["doc_id"], k // 4096, k, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes())] += 1
    rows = packing.pack(df, queries.tokenizer_path()).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    filled = defaultdict(list)
    for r in rows:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in filled.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 4096
    least = -(-sum(r["length"] for r in rows) // 4096)
    assert len(filled) <= 1.03 * least + 1


def test_words_give_the_ids_of_texts(rows):
    ids = packing.word_ids(queries.tokenizer_path())
    texts = [t or "" for _, t, _, _ in rows] + ["Ça va? ÉTÉ ﬁn «oui». don't we'll '", "a" * 500 + " <|endoftext|> ẞ İstanbul ΣΑΣ", "\x1c a\x85b c d", "漢字かな，テスト。abc。def.", "x.'s y,'t it's!'re é! é!"]
    for text, e in zip(texts, ids.tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(ids.encode(text.encode()), "<u4").tolist() == e.ids


def test_added_tokens_in_any_case_give_the_ids_of_texts():
    ids = packing.word_ids(queries.tokenizer_path())
    rng = random.Random(12)
    added = [t.content for t in ids.tokenizer.get_added_tokens_decoder().values()]
    assert added
    in_case = lambda t: rng.choice([str, str.upper, str.title, lambda x: "".join(rng.choice([c, c.upper()]) for c in x)])(t)
    bits = ["a", "B", "été", "É", " ", "\n", ".", "'s", "<|", "|>", "12", "漢", "Word.", "<|endoftext", "\x85"]
    texts = ["a <|ENDOFTEXT|> b", "<|EndOfText|>", *("".join(in_case(rng.choice(added)) if rng.random() < 0.4 else rng.choice(bits) for _ in range(rng.randint(1, 8))) for _ in range(10_000))]
    assert ids.tokenizer.encode("a <|ENDOFTEXT|> b", add_special_tokens=False).ids == [320, 27, 347, 40786, 4160, 91, 285, 321]
    wrong = [t for t, e in zip(texts, ids.tokenizer.encode_batch(texts, add_special_tokens=False)) if np.frombuffer(ids.encode(t.encode()), "<u4").tolist() != e.ids]
    assert not wrong, wrong[:3]


def test_best_fit_bounds_open_bins():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 101, 5000).tolist()
    few, many = (len({s for s, _ in packing.best_fit(lengths, 100, n)}) for n in (4, 1000))
    assert sum(lengths) / 100 <= many <= few <= 1.2 * sum(lengths) / 100
    assert packing.best_fit([60, 50, 40, 50], 100, 10) == [(0, 0), (1, 0), (0, 60), (1, 50)]
    assert packing.best_fit([60, 50, 45, 40], 100, 1) == [(0, 0), (1, 0), (1, 50), (2, 0)]
    assert packing.pieces is not None


# Pipeline


def test_pipeline_stages(spark, docs, odd, none, tmp_path):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "simhash_near_dedup", "source_mix", "best_fit_packing"]
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda df: Counter(r["doc_id"] for r in df.collect())
    one = stages["language_id"](spark, docs, SF)
    assert ids(one) == Counter(r["doc_id"] for r in langid.identify(docs).collect() if not r["rejected"])
    two = stages["exact_dedup"](spark, one, SF)
    assert ids(two) == Counter(r["doc_id"] for r in exact.exact_duplicates(one).collect() if r["kept"])
    three = stages["simhash_near_dedup"](spark, two, SF)
    assert ids(three) == Counter(r["doc_id"] for r in simhash.near_duplicates(two, 3, 3).select(simhash.ID, "component_id").toDF("doc_id", "c").collect() if r["doc_id"] == r["c"])
    four = stages["source_mix"](spark, three, SF)
    copies = {r["doc_id"]: round(r["taken"] / r["size"]) for r in mixing.taken_words(mixing.mix(three)).collect() if r["taken"]}
    assert ids(four) == Counter({i: n for i, n in copies.items() if n})
    five = stages["best_fit_packing"](spark, four, SF)
    assert Counter(r["doc_id"] for r in five.collect() if r["piece"] == 0) == ids(four)
    assert all(df.columns == docs.columns for df in (one, two, three, four))


@pytest.mark.parametrize("which", ["odd", "none"])
def test_stages_of_odd_tables(spark, request, which):
    df = request.getfixturevalue(which)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, SF)
        assert out.count() <= 2 * df.count() + 20
        if name != "best_fit_packing":
            assert out.columns == df.columns


def test_long_text_is_whole(odd):
    assert odd.where("doc_id = 6").first()["text"] == LONG
