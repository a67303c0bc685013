"""The trie of conversations and their repair, against brute force."""

import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from featmart.llm import repair, trie
from tests import oracle

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, key int, n long, gone string"


def conversation_frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA).repartition(3)


# --- trie


def brute_trie(sequences):
    """{path: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved, ends)} of {conv_id: [(role, text)]}."""
    members = {}
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    children, leaves, saved = {}, {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = leaves.get(path, 0) or 1
        saved[path] = saved.get(path, 0) + ((len(members[path]) - 1) * len(path[-1][1]) if path else 0)
        if path:
            up = path[:-1]
            children[up] = children.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[path]
            saved[up] = saved.get(up, 0) + saved[path]
    ends = lambda p: ",".join(str(c) for c in sorted(c for c in members[p] if len(sequences[c]) == len(p)))
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), children.get(p, 0), leaves[p], saved[p], hashlib.sha256(ends(p).encode()).hexdigest())
        for p, m in members.items()
    )


def trie_rows(frame):
    columns = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return sorted(tuple(-1 if r[c] is None else r[c] for c in columns) for r in frame.collect())


def turns_of(rows):
    """Sequences as the operator takes them, from (conv_id, turn, role, text)."""
    out = {}
    for conv, turn, role, text in sorted(((c, t, r or "", x or "") for c, t, r, x in rows if c is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2], r[3])):
        out.setdefault(conv, []).append((role, text))
    return out


@pytest.mark.parametrize("per_range", [1, 3, 10, 8192])
def test_trie_of_random_conversations(spark, per_range):
    rng = random.Random(per_range)
    rows = []
    for conv in range(120):
        n = rng.choice([0, 1, 2, 5, 12])
        kind = rng.random()
        for turn in range(n):
            text = "same" if kind < 0.3 else rng.choice(["a", "bb", "ccc", "é", ""])
            rows.append((conv * 7, turn, "user" if turn % 2 == 0 else "assistant", text))
    made = trie.sequences(conversation_frame(spark, rows))
    assert trie_rows(trie.prefix_trie(made, per_range)) == brute_trie(turns_of(rows))


def test_trie_with_common_beginnings(spark):
    rng = random.Random(3)
    rows = [(conv, turn, "user", rng.choice("ab") * 3) for conv in [*range(0, 40), *range(95, 230, 3), 400] for turn in range(rng.randint(1, 9))]
    own = turns_of(rows)
    want = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        want[conv] = own.get(conv - conv % 100, [])[:h] + turns[h:]
    made = trie.with_common_beginnings(trie.sequences(conversation_frame(spark, rows)))
    assert trie_rows(trie.prefix_trie(made, 16)) == brute_trie(want)


def test_trie_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(trie, "ID_BLOCK", 3)
    rows = [(None, 1, "user", "x"), (1, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (2, None, "", ""), (2, 0, "user", None), (3, 5, "user", "y" * 50_000)]
    rows += [(c, 0, "user", "hot") for c in range(-9, 60)] + [(c, 1, "assistant", "hot") for c in range(20, 60)] + [(77, t, "user", "z") for t in range(900)]
    assert trie_rows(trie.prefix_trie(trie.sequences(conversation_frame(spark, rows)), 4)) == brute_trie(turns_of(rows))
    assert trie.prefix_trie(trie.sequences(conversation_frame(spark, []))).collect() == []


def test_tree_holds_every_beginning():
    rng = random.Random(4)
    rows = sorted({tuple(rng.choices(range(5), k=rng.randint(0, 6))) for _ in range(300)})
    tree = trie.Tree()
    assert sorted(trie.medians_first(len(rows))) == list(range(len(rows)))
    ends = {tree.insert(list(rows[i])): rows[i] for i in trie.medians_first(len(rows))}
    assert len(ends) == len(rows) and len(tree.symbol) == len({r[:d] for r in rows for d in range(len(r) + 1)})
    for node, row in ends.items():
        path = []
        while node:
            path.append(tree.symbol[node])
            node = tree.parent[node]
        assert tuple(path[::-1]) == row


def test_queries_against_sql(spark, registered):
    for name in ("op12_prefix_trie", "op11_suffix_dedup", "op4_edited_texts", "op7_rules", "op8_base_scores"):
        assert oracle.compare(registered[name].run(spark, SF), oracle.connect(SF), registered[name].sql) is None


# --- repair


def brute_repair(rows):
    """Counts, cost, audit and repaired text of the rows (turn, role, text) in order, by search from the end."""
    space = " \t\n\v\f\r"
    faults, seen, marks = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
    for _, role, text in rows:
        core = text.strip(space)
        kind = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else ""
        seen.add((role, text))
        if kind:
            faults[kind] += 1
        marks.append(kind)
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    @cache
    def best(i, state, inserted):
        """The least (cost, edits, turns) from row i on."""
        found = [(0, "", ())] if i == len(rows) and state in (0, 3) else []
        new = "assistant" if state == 2 else "user"
        after = step[state, new[0]]
        if inserted < 3:
            tail = best(i, after, inserted + 1)
            if tail:
                found.append((5 + tail[0], "I" + tail[1], ((new, ""), *tail[2])))
        if i < len(rows):
            _, role, text = rows[i]
            tail = best(i + 1, state, 0)
            if tail:
                found.append((2 + tail[0], "D" + tail[1], tail[2]))
            if marks[i] not in ("blank", "duplicate"):
                more = 5 if marks[i] == "truncated" else 0
                to = step.get((state, role[:1]))
                tail = to is not None and best(i + 1, to, 0)
                if tail:
                    found.append((more + tail[0], "K" + tail[1], ((role, text), *tail[2])))
                tail = best(i + 1, after, 0)
                if tail:
                    found.append((1 + more + tail[0], "R" + tail[1], ((new, text), *tail[2])))
        return min(found, default=None)

    cost, audit, turns = best(0, 0, 0)
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    text = "\n".join(f"{r}:{t}" for r, t in turns)
    return gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()


def brute_damage(rows):
    """{conv_id: rows in order} after the damage."""
    out = {}
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept = out.setdefault(conv, [])
        kept += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, v in out.items()}


def test_repair_of_random_conversations():
    rng = random.Random(8)
    for _ in range(3000):
        roles = rng.choice([["user", "assistant"], ["user", "assistant", "system"], ["system"], ["user"], ["assistant", "tool", ""]])
        n = rng.choice([0, 1, 2, 4, 7, 11])
        rows = [(rng.choice([None, i, i, i + 3]), rng.choice(roles), rng.choice(["a.", "b!", "c?", f"x{i}.", f"y{i}.", "z", "", " \t", f"t{i}"])) for i in range(n)]
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        now, seen, edits = repair.Conversation(1, lambda *e: edits.append(e)), set(), []
        edits.clear()
        for turn, role, text in rows:
            now.row(turn, role, text, (role, text) in seen)
            seen.add((role, text))
        got = now.finish()
        assert got[1:] == brute_repair(rows), rows
        assert "".join(e[2] for e in edits) == got[7]


def test_memory_stays_small_in_a_long_conversation():
    rng = random.Random(9)
    for roles in (["user", "assistant"], ["user", "assistant", "system", "tool"], ["user", "user", "assistant", "assistant", "system"]):
        settled = []
        survivors = repair.Survivors(lambda *e: settled.append(e[0]))
        for i in range(20_000):
            survivors.row(rng.choice(roles), f"t{i}.", rng.random() < 0.05, rng.random() < 0.2)
            if i % 100 == 0:
                depth = max(node.depth for _, node in survivors.held.values())
                assert depth - survivors.base.depth < 200
        assert len(settled) > 19_000
        survivors.finish()


def test_damage_and_repair_of_odd_rows(spark):
    rng = random.Random(10)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None]), rng.choice(["Yes. ", "No!", "cut of", None, "", f"t{t}."])) for c in [*range(80), None] for t in range(rng.randint(1, 9))]
    rows += [(200, None, "user", "a."), (200, None, "assistant", "b."), (200, 7, "user", "c" * 50_000 + "."), (201, 4, "user", "x."), (201, 4, "user", "x.")]
    frame = conversation_frame(spark, rows)
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.repair(repair.damaged(frame), gone=repair.F.col("gone")).collect()}
    assert got == {c: brute_repair(tuple(v)) for c, v in brute_damage(rows).items()}
    none = conversation_frame(spark, [])
    assert repair.repair(repair.damaged(none), gone=repair.F.col("gone")).collect() == []
    assert repair.repaired_turns(none).collect() == []


def test_repaired_turns_are_legal(spark):
    rows = [(c, t, ["user", "assistant", "system"][(c + t) % 3], f"text {c} {t}" + "." * (t % 2)) for c in range(30) for t in range(2000 if c == 3 else 6)]
    frame = conversation_frame(spark, rows)
    edits = sorted((r["conv_id"], r["place"], r["edit"], r["role"]) for r in repair.repaired_turns(frame).collect())
    audits = {r["conv_id"]: r["audit"] for r in repair.repair(frame).collect()}
    for conv, audit in audits.items():
        mine = [e for e in edits if e[0] == conv]
        assert "".join(e[2] for e in mine) == audit and [e[1] for e in mine] == list(range(len(audit)))
        assert re.fullmatch("(s?(ua)+)?", "".join(e[3][0] for e in mine if e[2] != "D"))


def test_repair_query(spark, registered):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r)[1:] for r in registered["op13_structure_repair"].run(spark, SF).collect()}
    assert got == {c: brute_repair(tuple(v)) for c, v in brute_damage(rows).items()}
