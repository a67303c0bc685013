"""JSON files read in byte ranges against parsing them whole."""

import json
import random

import pytest

from featmart.sources import results
from featmart.sources.split_json import SplitJsonReader, read_entries

ODD = ['a],"b', '"', "\\", "\\\\\"", "{[", ']}', "é漢\U0001f600", ",", ':[1],', "", "x\\"]


def documents(rng, n):
    """Objects and arrays with brackets, quotes and backslashes in strings."""

    def value(depth):
        kind = rng.randint(0, 5 if depth < 3 else 2)
        if kind == 0:
            return rng.choice(ODD) * rng.randint(0, 3)
        if kind < 3:
            return rng.choice([1, -2.5, None, True, 1e9])
        many = range(rng.randint(0, 5))
        return [value(depth + 1) for _ in many] if kind < 5 else {rng.choice(ODD) + str(i): value(depth + 1) for i in many}

    return [rng.choice([lambda: {rng.choice(ODD) + str(i): value(1) for i in range(rng.randint(0, 9))}, lambda: [value(1) for _ in range(rng.randint(0, 9))]])() for _ in range(n)]


def parsed(path, entry, whole):
    try:
        return json.loads(entry)
    except json.JSONDecodeError:
        return json.loads("{" + entry + "}")


@pytest.mark.parametrize("seed", range(3))
def test_any_range_gives_the_entries_of_the_documents(spark, tmp_path, seed):
    rng = random.Random(seed)
    want = []
    for i in range(2):
        made = documents(rng, 12)
        text = "".join(json.dumps(d, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1])) + rng.choice(["", "\n", "  "]) for d in made)
        (tmp_path / f"{i}.json").write_text(text)
        for d in made:
            want += [json.dumps({k: v} if isinstance(d, dict) else v) for k, v in (d.items() if isinstance(d, dict) else enumerate(d))]
    for size in (7, 64, 1 << 20):
        got = [json.dumps(parsed(r["path"], r["entry"], want)) for r in read_entries(spark, str(tmp_path), size).collect()]
        # An entry that is a string of an array and one of an object are told apart by their text.
        assert sorted(got) == sorted(want), size


def test_a_large_document_is_read_by_many_tasks(spark, tmp_path):
    rng = random.Random(5)
    whole = {f"id {i} ]}},\"{i}": [rng.random() for _ in range(200)] for i in range(3000)}
    (tmp_path / "large.json").write_text(json.dumps(whole))
    size = (tmp_path / "large.json").stat().st_size
    rows = results.large_result_rows(spark, str(tmp_path / "large.json"), range_bytes=size // 8 + 1)
    assert rows.rdd.getNumPartitions() == 8
    assert {r["sample_id"]: r["outputs"] for r in rows.collect()} == whole
    counts = rows.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert min(counts) > 300


def test_expected_outputs_empty_and_compressed_files(spark, tmp_path):
    samples = [{"sampleId": f"s{i}", "input": [i, 0.5], "expected": [float(i)]} for i in range(50)]
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "expected.json").write_text(json.dumps(samples))
    got = results.large_expected_rows(spark, str(tmp_path / "a"), range_bytes=100).collect()
    assert sorted((r["sample_id"], r["input"], r["expected"]) for r in got) == sorted((s["sampleId"], s["input"], s["expected"]) for s in samples)
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "empty.json").write_text("")
    assert read_entries(spark, str(tmp_path / "b")).collect() == []
    (tmp_path / "b" / "none.json").write_text(" {} [] ")
    assert read_entries(spark, str(tmp_path / "b"), 2).collect() == []
    with pytest.raises(ValueError, match="compressed"):
        (tmp_path / "c").mkdir()
        (tmp_path / "c" / "x.json.gz").write_bytes(b"")
        SplitJsonReader({"path": f"file://{tmp_path / 'c'}"}).partitions()
