from __future__ import annotations

import hashlib
import heapq
import random
import zlib
from collections import defaultdict

from tierwise.llm import conversations, queries

SCHEMA = "conv_id long, turn long, role string, text string, fp string, kind string, h1 string, found string"
WHITE = " \t\n\x0b\x0c\r"


def cheapest(symbols):
    """Cheapest edits, ASCII-least, by search over whole edit strings."""
    want, after = {0: "u", 1: "u", 2: "a", 3: "u"}, {"s": 1, "u": 2, "a": 3}
    queue, seen = [(0, "", 0, 0, ())], set()
    while True:
        cost, audit, at, state, out = heapq.heappop(queue)
        if at == len(symbols) and state in (0, 3):
            return cost, audit, out
        if (at, state) in seen:
            continue
        seen.add((at, state))
        role = want[state]
        heapq.heappush(queue, (cost + 5, audit + "I", at, after[role], (*out, (role, None))))
        if at < len(symbols):
            letter, fault = symbols[at]
            heapq.heappush(queue, (cost + 2, audit + "D", at + 1, state, out))
            if fault not in ("blank", "duplicate"):
                cost += 5 if fault == "truncated" else 0
                if letter == role or (letter == "s" and state == 0):
                    heapq.heappush(queue, (cost, audit + "K", at + 1, after[letter], (*out, ("", at))))
                heapq.heappush(queue, (cost + 1, audit + "R", at + 1, after[role], (*out, (role, at))))


def brute(rows, damage):
    convs = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20 if damage else 9
        convs[conv] += []
        if fate == 0:
            continue
        if fate == 1:
            text = ""
        elif fate == 2:
            text = text.replace(".", "").replace("!", "").replace("?", "")
        elif fate == 4:
            role = "user"
        convs[conv] += [(turn, role, text)] * (2 if fate == 3 else 1)
    out = []
    for conv, said in convs.items():
        said.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        seen, symbols = set(), []
        for _, role, text in said:
            bare = text.strip(WHITE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            symbols.append((role[:1], fault))
        counts = [sum(f == name for _, f in symbols) for name in ("blank", "duplicate", "truncated")]
        illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(symbols, symbols[1:]))
        turns = {t for t, _, _ in said if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit, edits = cheapest(symbols)
        name = {"u": "user", "a": "assistant"}
        lines = [f"{name[r]}:{'' if at is None else said[at][2]}" if r else f"{said[at][1]}:{said[at][2]}" for r, at in edits]
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def ran(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_against_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").collect()
    want = brute([(r.conv_id, r.turn, r.role, r.text) for r in rows], True)
    assert ran(queries.op13_conversation_repair(spark, "/root/testdata/sf0.01")) == want
    assert sum(w[6] > 0 for w in want) > 20


def messy_rows(seed):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(120)]:
        n = rng.choice([1, 2, 3, 6, 11])
        turns = rng.sample(range(20), n) + ([None] if rng.random() < 0.2 else [])
        for turn in turns:
            role = rng.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"])
            text = rng.choice([None, "", " \t ", "\n", "Yes.", "Yes.", "so", "Why? ", "é!\r\n", "no more", "x" * 3000 + "."])
            rows.append((conv, turn, role, text, "1", None, "a", "b"))
    return rows


def test_messy_conversations_against_brute_force(spark):
    for seed in (1, 2):
        rows = messy_rows(seed)
        table = spark.createDataFrame(rows, SCHEMA)
        assert ran(conversations.repair(conversations.damaged(table), present="present")) == brute(rows, True)
        assert ran(conversations.repair(table)) == brute(rows, False)


def test_repaired_texts_follow_the_grammar(spark):
    rows = messy_rows(3)
    got = conversations.repair(spark.createDataFrame(rows, SCHEMA), with_text=True).collect()
    for r in got:
        assert hashlib.sha256(r.repaired.encode()).hexdigest() == r.repaired_sha256


def test_one_conversation_holds_most_rows_and_many_are_alike(spark):
    rows = [(0, t, "user" if t % 2 == 0 else "assistant", f"said {t % 50}." if t % 7 else "cut") for t in range(4000)]
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"{c} {t}.") for c in range(1, 900) for t in range(2)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert ran(conversations.repair(table)) == brute(rows, False)


def test_repeated_rows_ties_and_empty_table(spark):
    rows = [(1, 0, "user", "Hi.")] * 50 + [(1, 1, "assistant", "Yes.")] * 2 + [(2, None, "user", "a"), (2, None, "user", "a")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert ran(conversations.repair(table)) == brute(rows, False)
    nothing = spark.createDataFrame([], SCHEMA)
    assert conversations.repair(conversations.damaged(nothing), present="present").count() == 0


def test_every_node_of_the_automaton_is_least(spark):
    rng = random.Random(4)
    for _ in range(3000):
        symbols = [(rng.choice("suat"), rng.choice(["", "", "", "truncated", "blank"])) for _ in range(rng.randint(0, 9))]
        fault = {"": conversations.SOUND, "truncated": conversations.CUT, "blank": conversations.REMOVED}
        codes = bytes(conversations.symbol_code(s, fault[f]) for s, f in symbols)
        path = [conversations.END]
        for code in codes[::-1]:
            path.append(conversations.node(code, path[-1][0]))
        assert (path[-1][0][0], "".join(conversations.edits_of(codes, path))) == cheapest(symbols)[:2]
