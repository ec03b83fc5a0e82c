"""Conversation repair against plain versions: all edits tried, and a row-by-row search."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from driftlake.llm import turn_repair as tr
from driftlake.llm.queries import op11_turn_repair

PATTERN = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.rstrip(SPACE)
        fault = "b" if not body else "d" if (role, text) in seen else "" if body[-1] in ".!?" else "t"
        seen.add((role, text))
        out.append(fault)
    return out


def every_edit(rows):
    """Least cost, audit and repaired rows by trying everything (two inserts in a row at most)."""
    faults, best = faults_of(rows), None
    per_row = []
    for (role, text), fault in zip(rows, faults):
        extra = 3 if fault == "t" else 0
        options = [("D", 4, [])]
        if fault not in ("b", "d"):
            options.append(("K", extra, [(role, text)]))
            options += [("R", 3 + extra, [(r, text)]) for r in ("user", "assistant")]
        per_row.append(options)
    fills = [("I" * n, 3 * n, list(zip(roles, [""] * n)))
             for n in range(3) for roles in itertools.product(("user", "assistant"), repeat=n)]
    for choice in itertools.product(*per_row):
        for gaps in itertools.product(fills, repeat=len(rows) + 1):
            steps = [gaps[0]] + [x for pair in zip(choice, gaps[1:]) for x in pair]
            out = [row for s in steps for row in s[2]]
            if PATTERN.fullmatch("".join(role[:1] or "-" for role, _ in out)):
                found = (sum(s[1] for s in steps), "".join(s[0] for s in steps), out)
                if best is None or found[:2] < best[:2]:
                    best = found
    return best


def row_by_row(rows):
    """The same for long conversations: the best audit up to each row for each state."""
    moves = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    fill = {"": "u", "s": "u", "u": "a", "a": "u"}
    states = {"": (0, "")}

    def with_inserts(states):
        out = {}
        for state, (cost, audit) in states.items():
            for n in range(4):
                found = (cost + 3 * n, audit + "I" * n)
                out[state] = min(out.get(state, found), found)
                state = fill[state]
        return out

    for (role, _), fault in zip(rows, faults_of(rows)):
        extra, then = 3 if fault == "t" else 0, {}
        for state, (cost, audit) in states.items():
            for n in range(4):
                options = [(4, "D", state)]
                if fault not in ("b", "d"):
                    options += [(extra, "K", moves.get((state, role[:1])))]
                    options += [(3 + extra, "R", moves.get((state, r))) for r in "ua"]
                for price, letter, end in options:
                    if end is not None:
                        found = (cost + 3 * n + price, audit + "I" * n + letter)
                        then[end] = min(then.get(end, found), found)
                state = fill[state]
        states = then
    states = with_inserts(states)
    return min(states[s] for s in ("", "a") if s in states)


def applied(rows, audit):
    out, rows, names = [], iter(rows), {"s": "user", "u": "assistant", "a": "user", "": "user"}
    for letter in audit:
        here = names[out[-1][0][0] if out else ""]
        if letter == "I":
            out.append((here, ""))
            continue
        role, text = next(rows)
        if letter != "D":
            out.append((role if letter == "K" else here, text))
    return "\n".join(f"{r}:{t}" for r, t in out)


def in_order(turns):
    """Rows of each conversation as the operator orders them."""
    found = {}
    for conv, turn, role, text in turns:
        role, text = " " if role is None else role, " " if text is None else text
        found.setdefault(conv, []).append((turn is not None, turn or 0, role, hashlib.sha256(text.encode()).digest(), text))
    return {c: [((t if has else None), r, x) for has, t, r, _, x in sorted(rows)] for c, rows in found.items()}


def expected(turns, search):
    out = {}
    for conv, rows in in_order(turns).items():
        plain = [(r, x) for _, r, x in rows]
        cost, audit = search(plain)[:2]
        faults, known = faults_of(plain), [t for t, _, _ in rows if t is not None]
        pairs = [(a[0][:1] + b[0][:1]) for a, b in zip(plain, plain[1:])]
        text = applied(plain, audit)
        out[conv] = (
            max(known) - min(known) + 1 - len(set(known)) if known else 0, faults.count("b"), faults.count("d"),
            faults.count("t"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256(text.encode()).hexdigest(), text)
    return out


def result(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256,
                        r.repaired) for r in rows}


SCHEMA = "conv_id long, turn long, role string, text string, audit string, kind string, copies string"
ROLES = ["system", "user", "assistant", "tool", "", "User", None, "user", "assistant", "user", "assistant"]
TEXTS = ["Yes.", "no", "", " \t", "Why?", "x\n", "a.b", "! \n", None, "é。", "ok"]


def make(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def random_turns(seed, conversations, longest):
    rng = random.Random(seed)
    return [
        (conv if conv else None, rng.choice([None, *range(8)]), rng.choice(ROLES), rng.choice(TEXTS))
        for conv in range(conversations) for _ in range(rng.randint(1, longest))
    ]


def test_every_edit_of_short_conversations(spark):
    rows = random_turns(1, 150, 3)
    want = expected(rows, every_edit)
    assert result(tr.repair(make(spark, rows), with_text=True)) == want
    assert any("I" in w[6] for w in want.values()) and any("R" in w[6] for w in want.values())


def test_searches_agree():
    rng = random.Random(5)
    for _ in range(120):
        rows = [(rng.choice(ROLES) or " ", rng.choice(TEXTS) or " ") for _ in range(rng.randint(0, 3))]
        assert every_edit(rows)[:2] == row_by_row(rows)


def test_longer_conversations_with_ties_and_repeats(spark):
    rows = random_turns(2, 300, 30)
    rows += rows[:50]
    assert result(tr.repair(make(spark, rows), with_text=True)) == expected(rows, row_by_row)


def test_one_hot_conversation_over_many_segments(spark, settings):
    """Two thirds of all rows in one conversation, many of them equal; small Arrow batches."""
    settings(spark__sql__execution__arrow__maxRecordsPerBatch="700")
    rng = random.Random(3)
    rows = [(1, t, rng.choice(ROLES), f"{rng.choice(TEXTS)}{rng.randint(0, 900)}{rng.choice('.?!x')}") for t in range(12_000)]
    rows += [(1, 77, "user", "Same.")] * 9000 + random_turns(4, 400, 20)
    assert result(tr.repair(make(spark, rows).repartition(9), with_text=True)) == expected(rows, row_by_row)


def test_very_long_text(spark):
    text = "long words. " * 300_000 + "end"
    rows = [(1, 0, "user", text), (1, 1, "assistant", text + "."), (1, 2, "user", text)]
    assert result(tr.repair(make(spark, rows), with_text=True)) == expected(rows, row_by_row)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        k = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        row = (conv, turn, "user" if k == 4 else role, text)
        out += [] if k == 0 else [row, row] if k == 3 else [row]
    return out


def test_registered_query(spark, tmp_path):
    lost = [(c, 5, "user", "Gone.") for c in range(1000, 1060)]
    rows = random_turns(6, 200, 9) + lost
    make(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    want = expected(damaged(rows), row_by_row)
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
           for r in op11_turn_repair(spark, str(tmp_path)).collect()}
    assert got == {c: want[c][:8] if c in want else empty for c, *_ in rows}
    assert empty in got.values()


def test_gaps_of_extreme_turns(spark):
    rows = [(1, -(1 << 63), "user", "A."), (1, (1 << 63) - 1, "assistant", "B."), (2, None, "user", "A.")]
    got = result(tr.repair(make(spark, rows), with_text=True))
    assert got[1][0] == tr.LARGEST and got[2][0] == 0


def test_rules_replace_what_they_count():
    rng = np.random.default_rng(0)
    for _ in range(50):
        symbols, owner = rng.integers(0, 4, 60), np.sort(rng.integers(0, 7, 60))
        rules = {p: 20 + i for i, p in enumerate(tr.choose([(a, b, 9) for a in range(4) for b in range(4)], 3))}
        found, of = tr.replace(symbols, owner, rules)
        inverse = {n: p for p, n in rules.items()}
        spelled = [(x, o) for s, o in zip(found.tolist(), of.tolist()) for x in inverse.get(s, (s,))]
        assert spelled == list(zip(symbols.tolist(), owner.tolist()))
        assert not any((a, b) in rules and a != b for a, b, x, y in zip(found, found[1:], of, of[1:]) if x == y)


@pytest.mark.parametrize("rounds", [0, 3])
def test_grammar_changes_no_result(rounds):
    """Matrices of whole sequences, with and without rules, against one row after another."""
    rng = np.random.default_rng(rounds)
    lengths = np.array([1, 2, 5, 40, 3, 64])
    symbols = rng.integers(0, tr.TERMINALS, lengths.sum())
    learned = []
    for _ in range(rounds):
        arena = tr.Arena(learned)
        coded, counts = arena.encode(symbols, lengths)
        owner = np.repeat(np.arange(len(counts)), counts)
        pairs, n = np.unique(np.stack([coded[:-1], coded[1:]])[:, owner[1:] == owner[:-1]], axis=1, return_counts=True)
        learned.append(tr.choose([(int(a), int(b), int(c)) for (a, b), c in zip(pairs.T, n)], 8))
    arena = tr.Arena(learned)
    roots = arena.roots(symbols, lengths)
    plain = tr.Arena([])
    for root, end, length in zip(roots, np.cumsum(lengths), lengths):
        node = np.array([symbols[end - length]])
        for s in symbols[end - length + 1 : end]:
            node = plain.compose(node, np.array([s]))
        reached = arena.cost[root] < tr.NEVER
        assert (arena.cost[root] == plain.cost[node[0]]).all()
        for i, j in zip(*np.nonzero(reached)):
            assert arena.audit(root, i, j) == plain.audit(int(node[0]), i, j)
