import hashlib
import itertools
import random
import re
import zlib

import pytest

from velomart.llm import conversation_repair as cr
from velomart.llm import queries

WHITE = " \t\n\x0b\f\r"


def plain_faults(rows):
    out, seen = [], set()
    for role, text in rows:
        body = text.rstrip(WHITE)
        if not body:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def plain_repair(rows):
    """Least (cost, audit, repaired rows), forwards over all edits: state is the last role's initial."""
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    whole = {"u": "user", "a": "assistant"}

    def with_inserts(best):
        for _ in range(4):
            for state, (cost, audit, out) in list(best.items()):
                for to in follows[state]:
                    if to in whole:
                        new = (cost + 3, audit + "I", (*out, (whole[to], "")))
                        if to not in best or new < best[to]:
                            best[to] = new
        return best

    best = with_inserts({"": (0, "", ())})
    for (role, text), fault in zip(rows, plain_faults(rows), strict=True):
        after = {}

        def offer(to, new):
            if to not in after or new < after[to]:
                after[to] = new

        late = 3 if fault == "truncated" else 0
        for state, (cost, audit, out) in best.items():
            offer(state, (cost + 4, audit + "D", out))
            if fault not in ("blank", "duplicate"):
                if role[:1] and role[:1] in follows[state]:
                    offer(role[:1], (cost + late, audit + "K", (*out, (role, text))))
                for to in follows[state]:
                    if to in whole:
                        offer(to, (cost + late + 3, audit + "R", (*out, (whole[to], text))))
        best = with_inserts(after)
    return min(best[state] for state in ("", "a") if state in best)


def plain_summary(rows):
    """rows: (turn, role, text) in any order."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    turns = [t for t, _, _ in rows if t is not None]
    faults = plain_faults([r[1:] for r in rows])
    legal = {"su", "ua", "au"}
    illegal = sum(a[1][:1] + b[1][:1] not in legal for a, b in itertools.pairwise(rows))
    cost, audit, out = plain_repair([r[1:] for r in rows])
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit), "\n".join(f"{r}:{t}" for r, t in out)


def damaged(rows):
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        for _ in range(2 if kind == 3 else 1):
            yield conv, turn, role, text


def expected(rows):
    found = {r[0]: ((0, 0, 0, 0, 0, 0, ""), "") for r in rows}
    after = sorted(damaged(rows), key=lambda r: str(r[0]))
    for conv, of in itertools.groupby(after, key=lambda r: r[0]):
        found[conv] = plain_summary([r[1:] for r in of])
    return {c: (*s, hashlib.sha256(t.encode()).hexdigest()) for c, (s, t) in found.items()}


def test_whole_tables(spark, tmp_path):
    for folder in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
        got = {r[0]: tuple(r)[1:] for r in queries.op13_conversation_repair(spark, folder).collect()}
        assert got == expected(rows)


def test_odd_conversations(spark, tmp_path):
    rng = random.Random(4)
    texts = ["Yes.", "no", "", " \n", "Why?  ", None, "Go!", "a.b", "x" * 70_000 + "."]
    roles = ["user", "assistant", "system", "tool", None, "", "anything"]
    rows = [
        (conv, turn if rng.random() > 0.1 else None, rng.choice(roles[: rng.randint(3, 7)]), rng.choice(texts))
        for conv in [None, *range(150)]
        for turn in sorted(rng.sample(range(20), rng.randint(1, 9)))
    ]
    # rows with a null turn are ties: keep one of them a conversation
    seen, unique = set(), []
    for r in rows:
        if (r[0], r[1]) not in seen:
            unique.append(r)
        seen.add((r[0], r[1]))
    frame = spark.createDataFrame(unique, "conv_id long, turn long, role string, text string")
    frame.selectExpr("*", "turn AS n", "role AS key", "text AS chunk", "1 AS damage").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r[0]: tuple(r)[1:] for r in queries.op13_conversation_repair(spark, str(tmp_path)).collect()}
    assert got == expected(unique)


def test_one_conversation_in_many_chunks(spark, tmp_path):
    rng = random.Random(9)
    roles = ["user", "assistant", "system", "tool"]
    rows = [(1, t, rng.choice(roles), f"{rng.random()}." if rng.random() > 0.2 else "same") for t in range(7000)]
    # every turn keeps or loses a pair, so the choice depends on a row far away
    rows += [(2, t, "user" if t % 2 else "assistant", f"{t}.") for t in range(5001)]
    rows += [(c, 0, "user", "alone.") for c in range(3, 40)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r[0]: tuple(r)[1:] for r in queries.op13_conversation_repair(spark, str(tmp_path)).collect()}
    assert got == expected(rows)


@pytest.mark.parametrize("length", [1, 2, 3, 7])
def test_fix_up_passes_reach_the_vectors_of_one_run(length):
    rng = random.Random(length)
    for _ in range(200):
        rows = [(rng.choice([0, 1, 2, 3]), rng.choice([0, 0, 1, 2, 3])) for _ in range(40)]
        chunks = [rows[i : i + length] for i in range(0, 40, length)]
        used = [cr._END] * len(chunks)
        found = [cr._level(cr._vectors(c, cr._END)[0]) for c in chunks]
        for _ in range(len(chunks)):
            needed = [*found[1:], cr._END]
            found = [cr._again(c, u, n, f) for c, u, n, f in zip(chunks, used, needed, found, strict=True)]
            if needed == used:
                break
            used = needed
        whole = cr._vectors(rows, cr._END)
        assert found == [cr._level(whole[i]) for i in range(0, 40, length)]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.op13_conversation_repair(spark, str(tmp_path)).collect() == []


def test_repaired_rows_and_equal_turns(spark):
    rows = [(1, 1, "user", "a."), (1, 1, "user", "a."), (1, None, "system", "s."), (1, 2, "user", "b."), (2, 1, "tool", "")]
    found = cr.repair(spark.createDataFrame(rows, "c string, t int, r string, x string"), "c", "t", "r", "x")
    assert [tuple(r) for r in found.audit.orderBy("conv").collect()] == [
        ("1", 0, 0, 1, 0, 2, 7, "KKDR"),
        ("2", 0, 1, 0, 0, 0, 4, "D"),
    ]
    assert [tuple(r) for r in found.rows.orderBy("conv", "n", "j").select("role", "text", "edit").collect()] == [
        ("system", "s.", "K"), ("user", "a.", "K"), ("assistant", "b.", "R"),
    ]
