import hashlib
import random
import re
import zlib

import duckdb
from pyspark.sql import functions as F

from arcash.llm import conversations as V

NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
NAMES = {"s": "system", "u": "user", "a": "assistant"}


def cheapest(turns):
    """(cost, audit) by a table over (row, state) filled from the end, apart from the search."""
    def insertions(v):
        for _ in range(3):
            for st in range(4):
                for r, to in NEXT[st].items():
                    if r != "s" and to in v:
                        v[st] = min(v.get(st, (1 << 40, "")), (v[to][0] + 3, "I" + v[to][1]))
        return v
    v = insertions({0: (0, ""), 3: (0, "")})
    for t in reversed(turns):
        w = {}
        for st in range(4):
            options = [(v[st][0] + 4, "D" + v[st][1])] if st in v else []
            for r, to in NEXT[st].items() if not t.must_go else ():
                stay = 3 * t.truncated
                if to in v and t.initial == r:
                    options.append((v[to][0] + stay, "K" + v[to][1]))
                elif to in v and r != "s":
                    options.append((v[to][0] + 3 + stay, "R" + v[to][1]))
            if options:
                w[st] = min(options)
        v = insertions(w)
    return v[0]


def every_edit(turns, most):
    """(cost, audit) by trying all edits that cost ``most`` at most."""
    found = []

    def go(i, roles, cost, audit):
        if cost > most:
            return
        if i == len(turns) and re.fullmatch("(s?(ua)+)?", roles):
            found.append((cost, audit))
        for r in "ua":
            go(i, roles + r, cost + 3, audit + "I")
        if i < len(turns):
            t = turns[i]
            go(i + 1, roles, cost + 4, audit + "D")
            if not t.must_go:
                go(i + 1, roles + (t.initial or "?"), cost + 3 * t.truncated, audit + "K")
                for r in "ua":
                    go(i + 1, roles + r, cost + 3 + 3 * t.truncated, audit + "R")
    go(0, "", 0, "")
    return min(found)


def random_turns(rnd, n):
    out = []
    for _ in range(n):
        gone = rnd.random() < .2
        out.append(V.Turn(rnd.choice(["s", "u", "u", "a", "a", "x", ""]), gone, not gone and rnd.random() < .25))
    return out


def repaired(turns, segment):
    r = V.Repair(segment)
    for i, t in enumerate(turns):
        r.add(t, NAMES.get(t.initial, t.initial), f"t{i}")
    return r.finish()


def replay(turns, audit):
    state, i, out = 0, 0, []
    for letter in audit:
        if letter == "I":
            r = "a" if state == 2 else "u"
            out.append(NAMES[r] + ":")
        else:
            t, text = turns[i], f"t{i}"
            i += 1
            if letter == "D":
                continue
            r = t.initial if letter == "K" else "a" if state == 2 else "u"
            out.append(f"{NAMES[r]}:{text}")
        state = NEXT[state][r]
    return hashlib.sha256("\n".join(out).encode()).hexdigest()


def test_search_is_optimal_at_every_segment_size():
    rnd = random.Random(4)
    for _ in range(700):
        turns = random_turns(rnd, rnd.choice([0, 1, 2, 3, 6, 12, 25]))
        want = cheapest(turns)
        for segment in (1, 2, 5, 256):
            cost, audit, digest = repaired(turns, segment)
            assert (cost, audit) == want and digest == replay(turns, audit)


def test_search_against_all_edits():
    rnd = random.Random(9)
    for _ in range(60):
        turns = random_turns(rnd, rnd.choice([0, 1, 2, 3, 4]))
        cost, audit, _ = repaired(turns, 2)
        assert (cost, audit) == every_edit(turns, cost)


def test_a_long_conversation_is_searched_in_bounded_pieces():
    turns = random_turns(random.Random(2), 20_000)
    cost, audit, digest = repaired(turns, 64)
    assert cost == cheapest_cost(turns) and digest == replay(turns, audit)


def cheapest_cost(turns):
    v = [0, 1 << 40, 3, 6]
    for t in turns:
        stay, w = 3 * t.truncated, [x + 4 for x in v]
        if not t.must_go:
            if t.initial == "s":
                w[1] = min(w[1], v[0] + stay)
            w[2] = min(w[2], min(v[0], v[1], v[3]) + stay + 3 * (t.initial != "u"))
            w[3] = min(w[3], v[2] + stay + 3 * (t.initial != "a"))
        w[2] = min(w[2], min(w[0], w[1], w[3]) + 3)
        w[3] = min(w[3], w[2] + 3)
        v = w
    return min(v[0], v[3])


def reports(rows):
    """The contract by plain Python over (conv_id, turn, role, text)."""
    convs = {}
    for conv, turn, role, text in rows:
        out = convs.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    found = {}
    for conv, out in convs.items():
        out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, turns, counts = set(), [], [0, 0, 0]
        for _, role, text in out:
            body = text.rstrip(" \t\n\x0b\f\r")
            fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else 3
            seen.add((role, text))
            if fault < 3:
                counts[fault] += 1
            turns.append(V.Turn(role[:1], fault < 2, fault == 2))
        known = [r[0] for r in out if r[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        pairs = [a.initial + b.initial for a, b in zip(turns, turns[1:])]
        cost, audit = cheapest(turns)
        state, i, kept = 0, 0, []
        for letter in audit:
            if letter == "I":
                r, line = "ua"[state == 2], NAMES["ua"[state == 2]] + ":"
            else:
                _, role, text = out[i]
                i += 1
                if letter == "D":
                    continue
                r = role[0] if letter == "K" else "ua"[state == 2]
                line = (role if letter == "K" else NAMES[r]) + ":" + text
            kept.append(line)
            state = NEXT[state][r]
        found[conv] = (gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                       hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return found


def conversations(seed=7):
    rnd = random.Random(seed)
    texts = ["Yes.", "No!", "so on", "  ", "", None, "\u3042\u3002", "x? \n", "y.\x0b", "\U0001f600"]
    rows = []
    for conv in [*range(150), None, 2 ** 60 + 1]:
        for turn in range(rnd.choice([1, 2, 4, 9])):
            rows.append((conv, rnd.choice([turn, turn, turn, turn + 2, None]),
                         rnd.choice(["user", "assistant", "assistant", "system", "tool", "", None]), rnd.choice(texts)))
    rows += [(5, t, "user" if t % 2 else "system", f"t{t % 90}.") for t in range(700)]
    rows += [(6, 1, "user", "again.")] * 6
    rnd.shuffle(rows)
    return rows


def test_matches_plain_python_and_sql(spark, tables):
    rows = conversations()
    d = tables(conversations=rows)
    got = {r[0]: tuple(r[1:]) for r in V.op13_conversations(spark, d).collect()}
    assert got == reports(rows)
    # segments of 16 rows, and other columns beside the four
    wide = spark.read.parquet(f"{d}/conversations.parquet").withColumn("m", F.lit("x")).withColumn("digest", F.lit(1))
    small = {r[0]: tuple(r[1:]) for r in V.repair_conversations(wide, damage=True, segment=16).collect()}
    assert small == got
    with duckdb.connect() as con:
        con.execute(f"create view conversations as select * from read_parquet('{d}/conversations.parquet/*.parquet')")
        names = ("gaps", "blank", "duplicate", "truncated", "illegal", "\"cost\"", "audit", "repaired_sha256")
        sql = {r[0]: r[1:] for r in con.execute(
            f"select conv_id, {', '.join(names)} from ({V.oracle_sql()}) where conv_id is distinct from 5").fetchall()}
    assert sql == {k: v for k, v in got.items() if k != 5}


def test_undamaged_rows_long_texts_and_empty_table(spark, tables):
    long = "word " * 400_000 + "."
    d = tables(conversations=[(1, 0, "user", long), (1, 1, "assistant", "ok."), (2, 0, "assistant", "hm")])
    rows = spark.read.parquet(f"{d}/conversations.parquet")
    got = {r.conv_id: r for r in V.repair_conversations(rows).collect()}
    assert (got[1].cost, got[1].audit) == (0, "KK")
    assert got[1].repaired_sha256 == hashlib.sha256(f"user:{long}\nassistant:ok.".encode()).hexdigest()
    assert (got[2].truncated, got[2].cost, got[2].audit) == (1, 4, "D")
    assert V.repair_conversations(rows.where(F.lit(False))).count() == 0
