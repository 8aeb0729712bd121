import functools
import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest

from tillroll.llm import audit

GOOD = re.compile("(s?(ua)+)?")


def faults_of(rows):
    out = []
    for i, (_, role, text) in enumerate(rows):
        bare = re.sub("[\x20\x09-\x0D]", "", text)
        out.append("blank" if not bare else "duplicate" if (role, text) in [r[1:] for r in rows[:i]]
                   else "truncated" if bare[-1] not in ".!?" else "")
    return out


def every_audit(rows, faults, inserts=2):
    """All edits of few rows, tried one by one."""
    best = None
    gaps = list(itertools.chain.from_iterable(
        itertools.product(["user", "assistant"], repeat=n) for n in range(inserts + 1)))
    for added in itertools.product(gaps, repeat=len(rows) + 1):
        for edits in itertools.product(["K", "D", "user", "assistant"], repeat=len(rows)):
            if any(f in ("blank", "duplicate") and e != "D" for f, e in zip(faults, edits)):
                continue
            cost, audit_, lines = 0, "", []
            for k in range(len(rows) + 1):
                cost += 5 * len(added[k])
                audit_ += "I" * len(added[k])
                lines += [f"{r}:" for r in added[k]]
                if k == len(rows):
                    break
                _, role, text = rows[k]
                if edits[k] == "D":
                    cost, audit_ = cost + 2, audit_ + "D"
                    continue
                cost += 5 * (faults[k] == "truncated") + (edits[k] != "K")
                audit_ += "K" if edits[k] == "K" else "R"
                lines.append(f"{role if edits[k] == 'K' else edits[k]}:{text}")
            if GOOD.fullmatch("".join(x[:1] for x in lines)):
                best = min(best or (cost, audit_, lines), (cost, audit_, lines))
    return best


def backwards(rows, faults):
    """Costs to the end first, then the least edit of a cheapest way at each step."""
    n = len(rows)

    def moves(i, state):
        if state != 2:
            yield "I", 5, i, 2, "user:"
        else:
            yield "I", 5, i, 3, "assistant:"
        if i == n:
            return
        _, role, text = rows[i]
        yield "D", 2, i + 1, state, None
        if faults[i] in ("blank", "duplicate"):
            return
        stay = 5 * (faults[i] == "truncated")
        to = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((role[:1], state))
        if to:
            yield "K", stay, i + 1, to, f"{role}:{text}"
        to, name = (3, "assistant") if state == 2 else (2, "user")
        yield "R", stay + 1, i + 1, to, f"{name}:{text}"

    @functools.cache
    def cost(i, state, inserted=0):
        here = [0] if i == n and state in (0, 3) else []
        return min(here + [c + cost(j, to, inserted + (e == "I" and 1)) if e == "I" else c + cost(j, to)
                           for e, c, j, to, _ in moves(i, state) if e != "I" or inserted < 2], default=10 ** 9)

    for i, state in itertools.product(range(n, -1, -1), range(4)):
        cost(i, state)  # from the end, so that no call goes deep
    i = state = inserted = 0
    path, lines = "", []
    while not (i == n and state in (0, 3) and cost(i, state, inserted) == 0):
        e, _, i2, state, line = min((m for m in moves(i, state) if m[0] != "I" or inserted < 2),
                                    key=lambda m: (m[1] + cost(m[2], m[3], inserted + 1 if m[0] == "I" else 0), m[0]))
        inserted = inserted + 1 if e == "I" else 0
        i, path = i2, path + e
        lines += [line] if line is not None else []
    return cost(0, 0), path, lines


ROLES = ["user", "assistant", "system", "tool", " ", "", "unit"]
WORDS = ["Yes.", "No", "", " \t", "Why?", "So.\n", "a\xa0", "b."]


def _random_rows(rng, n):
    return sorted(((None if rng.random() < 0.1 else int(rng.integers(0, 2 * n + 1)),
                    str(rng.choice(ROLES, p=[.35, .3, .15, .05, .05, .05, .05])), str(rng.choice(WORDS)))
                   for _ in range(n)), key=lambda r: (r[0] is not None, r[0] or 0))


def _check(rows, got):
    faults = faults_of(rows)
    cost, path, lines = backwards(rows, faults)
    assert (got["cost"], got["audit"]) == (cost, path)
    assert got["repaired_sha256"] == hashlib.sha256("\n".join(lines).encode()).hexdigest()
    assert [got[k] for k in ("blank", "duplicate", "truncated")] == [faults.count(k) for k in (
        "blank", "duplicate", "truncated")]
    first = [r[1][:1] for r in rows]
    assert got["illegal"] == sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))
    turns = {r[0] for r in rows if r[0] is not None}
    assert got["gaps"] == (max(turns) - min(turns) + 1 - len(turns) if turns else 0)


def test_few_rows_against_every_edit():
    rng = np.random.default_rng(2)
    for _ in range(40):
        rows = _random_rows(rng, int(rng.integers(0, 3)))
        cost, path, lines = every_audit(rows, faults_of(rows))
        assert backwards(rows, faults_of(rows)) == (cost, path, lines)
        got = audit.repair_one(rows)
        assert (got["cost"], got["audit"]) == (cost, path)


def test_many_rows_against_costs_from_the_end():
    rng = np.random.default_rng(3)
    for n in [*range(12)] * 25 + [60, 300]:
        rows = _random_rows(rng, n)
        _check(rows, audit.repair_one(rows))


@pytest.mark.parametrize("prime", [audit._PRIME, 7])
def test_comparing_audits(prime, monkeypatch):
    monkeypatch.setattr(audit, "_PRIME", prime)  # 7: nearly every hash collides
    rng = np.random.default_rng(prime % 100)
    audits, nodes = audit.Audits(), [0]
    for _ in range(400):
        nodes.append(audits.add(nodes[rng.integers(max(0, len(nodes) - 60), len(nodes))],
                                bytes(rng.choice(list(b"DK"), rng.integers(1, 4)).tolist())))
    for a, b in rng.choice(nodes, (3000, 2)):
        x, y = audits.string(a), audits.string(b)
        assert audits.less(a, b) == (x < y)
        assert audits.common(a, b) == next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))


def _frame(spark, conversations):
    rows = [(c, t, r or None if r == " " else r, x, 1, "k") for c, rs in conversations.items() for t, r, x in rs]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, times int, audit string")


@pytest.mark.parametrize("piece", [2048, 1, 3])
def test_pieces_give_the_same(spark, piece, monkeypatch):
    monkeypatch.setattr(audit, "PIECE_ROWS", piece)
    rng = np.random.default_rng(piece)
    conversations = {}
    for c in range(25):
        rows = _random_rows(rng, int(rng.choice([0, 1, 2, 5, 9, 40])))
        # one order whatever the ties: turns all different but for whole copies
        conversations[c if c else None] = [(i // 2 * 2 if rows[i // 2 * 2][0] is not None else i - 1000,
                                            *rows[i // 2 * 2][1:]) for i in range(len(rows))]
    conversations = {c: sorted(rs, key=lambda r: r[0]) for c, rs in conversations.items() if rs}
    got = {r["conv_id"]: r.asDict() for r in audit.repair(_frame(spark, conversations)).collect()}
    assert got.keys() == conversations.keys()
    for c, rows in conversations.items():
        _check([(t, r if r is not None else " ", x) for t, r, x in rows], got[c])


def test_one_conversation_over_many_tasks(spark):
    rows = [(7, i, "user" if i % 2 == 0 else "assistant", "Same." if i % 5 == 0 else f"Text {i}.", 1, "")
            for i in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, times int, audit string")
    got = audit.repair(df).collect()
    assert len(got) == 1
    _check([r[1:4] for r in rows], got[0].asDict())


def test_damage_and_conversations_left_empty(spark):
    rows = [(c, t, role, text) for c in (1, 2, None) for t in (None, *range(40))
            for role, text in [("user" if (t or 0) % 2 else "assistant", f"Say {t}. Right!"), (None, None)][:1 + (t == 3)]]
    gone = [(c, 0, "user", "Hi.") for c in range(100, 400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    df = spark.createDataFrame(rows + gone, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r.asDict() for r in audit.repaired_conversations(df).collect()}
    assert len(got) == 3 + len(gone)
    for c, _, _, _ in gone:
        assert [got[c][k] for k in audit._FIGURES] == [0] * 6
        assert got[c]["audit"] == "" and got[c]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    for c in (1, 2, None):
        after = []
        for _, t, role, text in [r for r in rows if r[0] == c]:
            k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
            role, text = role if role is not None else " ", text if text is not None else " "
            row = (t, "user" if k == 4 else role, "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text)
            after += [row] * {0: 0, 3: 2}.get(k, 1)
        after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        _check(after, got[c])


def test_long_text_and_empty_table(spark):
    long = "word " * 1_000_000
    df = spark.createDataFrame([(1, 0, "user", long + "."), (1, 1, "assistant", long)],
                               "conv_id long, turn long, role string, text string")
    got = audit.repair(df).first()
    assert (got.truncated, got.audit, got.cost) == (1, "DD", 4)
    assert audit.repaired_conversations(df.limit(0)).count() == 0
