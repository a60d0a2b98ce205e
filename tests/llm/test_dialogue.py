"""Repairs equal a search over whole strings, with and without hash collisions, and the contract's statement in SQL."""

import hashlib
import random
import re
import zlib

import pytest

from millrace.llm import dialogue
from millrace.llm.common import REGISTRY, table


def plain(rows):
    """The contract on one conversation's rows after damage, with whole audit strings per state."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
    seen, blank, again, torn_rows = set(), 0, 0, 0
    states = {0: (0, "", ())}

    def better(found, s, cell):
        if s not in found or cell[:2] < found[s][:2]:
            found[s] = cell

    def inserted(found):
        for _ in range(3):
            for s, (cost, audit, out) in list(found.items()):
                role, to = dialogue._WANTED[s]
                better(found, to, (cost + 5, audit + "I", (*out, f"{role}:")))
        return found

    inserted(states)
    for _, role, text in rows:
        is_blank, is_again = not re.search(r"[^\x20\x09-\x0D]", text), (role, text) in seen
        seen.add((role, text))
        torn = not is_blank and not is_again and re.search(r"[^\x20\x09-\x0D][\x20\x09-\x0D]*\Z", text)[0][0] not in ".!?"
        blank, again, torn_rows = blank + is_blank, again + (is_again and not is_blank), torn_rows + torn
        found = {}
        for s, (cost, audit, out) in states.items():
            better(found, s, (cost + 2, audit + "D", out))
            if is_blank or is_again:
                continue
            if (s, role[:1]) in dialogue._NEXT:
                better(found, dialogue._NEXT[s, role[:1]], (cost + 5 * torn, audit + "K", (*out, f"{role}:{text}")))
            wanted, to = dialogue._WANTED[s]
            better(found, to, (cost + 1 + 5 * torn, audit + "R", (*out, f"{wanted}:{text}")))
        states = inserted(found)
    cost, audit, out = min(states[s] for s in (0, 3) if s in states)
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return gaps, blank, again, torn_rows, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def streamed(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
    talk, seen = dialogue.Dialogue(), set()
    for turn, role, text in rows:
        talk.row(turn, role, text, (role, text) in seen)
        seen.add((role, text))
    return talk.result()


def made(rng, size):
    roles = rng.choice([["user", "assistant"], ["user", "assistant", "system"], ["system", "user", "assistant", "tool", " ", ""], ["user"], ["assistant"], ["system"]])
    texts = rng.choice([["", " \n", "a.", "b!", "c?"], [f"{i}." for i in range(40)], [f"{i}" for i in range(40)], ["x. ", "y", "z.", "w", ""]])
    return [(rng.choice([None, i, i, i, i // 2]), rng.choice(roles), rng.choice(texts)) for i in range(size)]


@pytest.mark.parametrize("prime", [None, 7])
def test_equals_a_search_over_strings(prime, monkeypatch):
    if prime:  # hashes that often collide, so that only the check of letters tells audits apart
        monkeypatch.setattr(dialogue, "_PRIME", prime)
        monkeypatch.setattr(dialogue, "_BASE", 3)
        monkeypatch.setattr(dialogue, "_OVER", pow(2, -1, prime))
    rng = random.Random(11)
    for n in range(1500):
        rows = made(rng, rng.randint(0, 12) if n % 10 else rng.randint(20, 60))
        assert streamed(rows) == plain(rows), rows


def test_long_ties_and_long_runs():
    same = [(i, "user", f"{i}.") for i in range(700)]
    assert streamed(same) == plain(same)
    gone = [(0, "user", "a."), (1, "assistant", "b.")] + [(i, "user", "") for i in range(2, 100_000)]
    got = dialogue.Dialogue()
    for turn, role, text in gone:
        got.row(turn, role, text, False)
    assert got.result()[5:7] == (2 * 99_998, "KK" + "D" * 99_998) and len(got.audits.letter) < 100


def test_audits_share_prefixes():
    audits, rng = dialogue.Audits(), random.Random(2)
    texts, nodes = [""], [0]
    for _ in range(600):
        i, letter, times = rng.randrange(max(0, len(nodes) - 4), len(nodes)), rng.choice("DIKR"), rng.choice([1, 1, 1, 5])
        nodes.append(audits.add(nodes[i], letter, times))
        texts.append(texts[i] + letter * times)
    for _ in range(3000):
        i, j = rng.randrange(len(nodes)), rng.randrange(len(nodes))
        common = next((k for k, (a, b) in enumerate(zip(texts[i], texts[j])) if a != b), min(len(texts[i]), len(texts[j])))
        assert audits.common(nodes[i], nodes[j]) == common
        assert audits.less(nodes[i], "D", nodes[j], "K") == (texts[i] + "D" < texts[j] + "K")
    assert [audits.text(n) for n in nodes] == texts


def test_many_nodes_are_given_back():
    talk = dialogue.Dialogue()
    for i in range(60_000):
        talk.row(i, ("user", "assistant")[i % 2], f"{i}.", False)
    assert len(talk.audits.letter) < 200_000 and talk.result()[5:7] == (0, "K" * 60_000)


def test_rows_of_tables(spark):
    rng = random.Random(4)
    talks = {c: made(rng, rng.randint(1, 9)) for c in [None, *range(40)]}
    rows = [(c, t, r or None, x or None, "clash") for c, talk in talks.items() for t, r, x in talk] + [(99, 1, "user", "gone.", "clash")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, what string").repartition(4)
    got = {r.conv_id: tuple(r)[1:] for r in dialogue.repair(df.selectExpr("*", "conv_id <=> 99 AS g", "NOT conv_id <=> 99 AS there"), there="there").collect()}
    assert got.pop(99) == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {c: plain([(t, r or " ", x or " ") for t, r, x in talk]) for c, talk in talks.items()}
    assert dialogue.repair(df.limit(0)).count() == 0


def test_damage(spark):
    rows = [(c, t, "system", "One. Two! Three") for c in (None, 1, 2) for t in (None, *range(60))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted((r.conv_id or -1, r.turn or -1, r.role, r.text) for r in dialogue.damage(df).where("there").collect())
    want = []
    for c, t, role, text in rows:
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if fault == 1 else "One Two Three" if fault == 2 else text
        want += [(c or -1, t or -1, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    assert got == sorted(want)


def test_query_equals_plain(spark):
    folder = "/root/testdata/sf0.01"
    talks = {}
    for r in table(spark, folder, "conversations").collect():
        fault = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", r.text) if fault == 2 else r.text
        talks.setdefault(r.conv_id, []).extend([(r.turn, "user" if fault == 4 else r.role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1))
    got = {r.conv_id: tuple(r)[1:] for r in REGISTRY["op12_audit_repair"].build(spark, folder).collect()}
    assert got == {c: plain(rows) for c, rows in talks.items()}
