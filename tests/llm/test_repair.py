import hashlib
import random
import re
import zlib

import pytest
from helpers import empty, with_clashes
from pagestrata.llm import repair
from pagestrata.llm.repair import damaged, edits, repair_digests, repair_turns

TURNS = "conv_id long, turn long, role string, text string"
BLANK = " \t\n\x0b\f\r"
NEXT = {"": ["u"], "s": ["u"], "u": ["a"], "a": ["u"]}
NAMES = {"u": "user", "a": "assistant"}


def ordered(rows):
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        core = text.rstrip(BLANK)
        out.append("blank" if not core else "duplicate" if (role, text) in seen else "" if core[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def brute(rows):
    """All of a conversation's digests, by the least (cost, audit) of each state after each row."""
    rows = ordered(rows)
    found = faults(rows)
    states = {"": (0, "", ())}
    for (_, role, text), fault in zip(rows, found):
        new = {}

        def offer(state, way):
            new[state] = min(way, new.get(state, way))

        for state, (cost, audit, out) in states.items():
            for n in range(3):
                offer(state, (cost + 2, audit + "D", out))
                if fault not in ("blank", "duplicate"):
                    extra = 5 * (fault == "truncated")
                    for to in NEXT[state]:
                        offer(to, (cost + 1 + extra, audit + "R", (*out, (NAMES[to], text))))
                    if role[:1] and role[0] in "sua" and (role[0] in NEXT[state] or (role[0] == "s" and state == "")):
                        offer(role[0], (cost + extra, audit + "K", (*out, (role, text))))
                state = NEXT[state][0]
                cost, audit, out = cost + 5, audit + "I", (*out, (NAMES[state], ""))
        states = new
    ends = [states[s] for s in ("", "a") if s in states]
    if "u" in states:
        c, a, o = states["u"]
        ends.append((c + 5, a + "I", (*o, ("assistant", ""))))
    if "s" in states:
        c, a, o = states["s"]
        ends.append((c + 10, a + "II", (*o, ("user", ""), ("assistant", ""))))
    cost, audit, out = min(ends)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    illegal = sum(p not in ("su", "ua", "au") for p in pairs)
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out))
    digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest()
    return (gaps, *(found.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest), list(out)


def conversations(spark, convs):
    rows = [(c, *row) for c, turns in convs.items() for row in turns]
    return spark.createDataFrame(rows, TURNS).repartition(3) if rows else empty(spark, TURNS)


def check(spark, convs):
    df = conversations(spark, convs)
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = {r["conv_id"]: tuple(r[n] for n in names) for r in repair_digests(df).collect()}
    want = {c: brute(turns) for c, turns in convs.items() if turns}
    assert got == {c: w[0] for c, w in want.items()}
    turns = {}
    for r in sorted(repair_turns(df).collect(), key=lambda r: (str(r["conv_id"]), r["place"], r["part"])):
        turns.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert turns == {c: w[1] for c, w in want.items() if w[1]}


def random_turns(rng, n, repeats=0.1):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "umpire", "", None]
    texts = ["Yes.", "No!", "cut off", "", " \n", None, "Why?", "and so", "ends.  \n"]
    turns = []
    for i in range(n):
        text = rng.choice(texts) if rng.random() < 0.3 else f"{i} text{rng.choice(['.', '!', '', '?'])}"
        turns.append((None if rng.random() < 0.05 else i, rng.choice(roles[: rng.choice([2, 5, 9])]), text))
    return turns + [t for t in turns if rng.random() < repeats]


def test_against_all_edits(spark):
    rng = random.Random(1)
    check(spark, {i: random_turns(rng, rng.randrange(1, 12)) for i in range(400)})


def test_chunks_and_hot_conversations(spark, monkeypatch):
    rng = random.Random(2)
    convs = {i: random_turns(rng, rng.randrange(1, 9)) for i in range(30)} | {100: random_turns(rng, 700), 101: random_turns(rng, 65)}
    for chunk in (4, 32):
        monkeypatch.setattr(repair, "CHUNK", chunk)
        check(spark, convs)


def test_nulls_ties_and_repeated_rows(spark):
    check(spark, {
        None: [(None, None, None), (1, "user", "Hi."), (1, "user", "Hi."), (2, "assistant", "Yes.")],
        1: [(1, "user", "A.")] * 5 + [(1, "user", "B."), (1, "assistant", "C.")],
        2: [(None, "user", "x."), (None, "user", "y.")], 3: [(5, None, "a.")], 4: [(5, "user", None)],
        5: [(-3, "system", "Rules.")], 6: [(1, "system", "s."), (9, "assistant", "a.")], 7: [(1, "", "a."), (2, "", "b.")],
        8: [(1, "user", "same."), (2, "assistant", "a."), (3, "user", "same.")],
    })


def test_long_and_odd_texts(spark):
    check(spark, {1: [(1, "user", "word " * 400_000 + "."), (2, "assistant", "." + " " * 300_000), (3, "user", "." * 300_000 + "x")],
                  2: [(1, "user", "ends\u0085."), (2, "assistant", "ends.\u0085"), (3, "user", "no\u00a0")]})


def test_empty_and_extra_columns(spark):
    assert repair_digests(conversations(spark, {})).collect() == []
    assert repair_turns(conversations(spark, {})).collect() == []
    df = with_clashes(conversations(spark, {1: [(1, "user", "a.")]}), "place", "copies", "digest", "fault", "first", "edits")
    assert [r["audit"] for r in repair_digests(df).collect()] == ["D"]


@pytest.mark.parametrize("seed", range(4))
def test_halves_meet_as_the_whole(seed):
    rng = random.Random(seed)
    for _ in range(60):
        codes = bytes(rng.choice([0, 1, 2, 3, 4, 5, 6, 7, 8]) for _ in range(rng.randrange(1, 40)))
        entry = rng.randrange(4)
        ways = {entry: (0, "")}
        for code in codes:
            new = {}
            for s, t, more, own in repair._LINKS[code]:
                if s in ways:
                    way = (ways[s][0] + more, ways[s][1] + own)
                    new[t] = min(way, new.get(t, way))
            ways = new
        for leave, (_, audit) in ways.items():
            assert "".join(edits(codes, entry, leave)) == audit


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(12) for t in range(12)] + [(None, 1, None, None), (1, None, "user", "x")]
    want = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        want += [(c, t, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    got = [tuple(r) for r in damaged(spark.createDataFrame(rows, TURNS)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
