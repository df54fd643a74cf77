"""Conversation repair, prefix trie and order fingerprints against brute force."""

import functools
import hashlib
import random
import re
import struct
import zlib
from collections import defaultdict

import pytest
import xxhash

from leasegrid.llm import conversation_repair, conversation_trie, order_minhash

SPACE = " \t\n\x0b\x0c\r"
STATES = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
WORDS = {"u": "user", "a": "assistant"}


def told(rows):
    """[(role, text, fault)] of rows in order."""
    out, seen = [], set()
    for role, text in rows:
        kept = text.rstrip(SPACE)
        fault = "blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def repaired_by_force(rows):
    """(cost, audit, [role:text]) from the end backwards, over all edits, with up to three inserts in a row."""
    rows = told(rows)

    @functools.cache
    def best(i, state, inserts):
        found = []
        if i == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        if inserts < 3:
            found += [(c + 2, "I" + e, (f"{WORDS[x]}:", *t)) for x in "ua" if (to := STATES.get((state, x))) for c, e, t in best(i, to, inserts + 1)]
        if i < len(rows):
            role, text, fault = rows[i]
            found += [(c + 3, "D" + e, t) for c, e, t in best(i + 1, state, 0)]
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if to := STATES.get((state, role[:1])):
                    found += [(c + extra, "K" + e, (f"{role}:{text}", *t)) for c, e, t in best(i + 1, to, 0)]
                found += [(c + 2 + extra, "R" + e, (f"{WORDS[x]}:{text}", *t)) for x in "ua" if (to := STATES.get((state, x))) for c, e, t in best(i + 1, to, 0)]
        return [min(found)] if found else []

    return best(0, "", 0)[0]


def streamed(rows):
    """The same by the operator, and the most nodes that were open at once."""
    out, repair, most = [], conversation_repair.Repair(), 0
    for role, text, fault in told(rows):
        go = fault in ("blank", "duplicate")
        out += repair.turn(role, text, int(go), not go, fault == "truncated")
        nodes = set()
        for _, leaf in repair.held.values():
            while leaf is not None:
                nodes.add(id(leaf))
                leaf = leaf.up
        most = max(most, len(nodes))
    cost, rest = repair.end()
    out += rest
    return (cost, "".join(e * n for e, n, _, _ in out), tuple(f"{r}:{t}" for e, _, r, t in out if e != "D")), most


def any_turns(rng, n):
    return [(rng.choice(["user", "assistant", "user", "assistant", "system", "tool", ""]), rng.choice(["Yes.", "no", "ok!", "", " \t", "Why?\n", "a", "b.", "c.", "d", "e."])) for _ in range(n)]


def test_repair_equals_brute_force():
    rng = random.Random(5)
    for n in [*range(9)] * 250:
        rows = any_turns(rng, n)
        assert streamed(rows)[0] == repaired_by_force(rows), rows
    for n in (60, 200):
        rows = [(rng.choice(["user", "assistant", "system"]), f"{i}{rng.choice(['.', ''])}") for i in range(n)]
        assert streamed(rows)[0] == repaired_by_force(rows)


@pytest.mark.parametrize("kind", ["clean", "all blank", "system and blanks", "one parity", "random", "runs of users"])
def test_repair_holds_few_edits(kind):
    rng = random.Random(6)
    rows = {
        "clean": [("user" if i % 2 == 0 else "assistant", f"{i}.") for i in range(4000)],
        "all blank": [("user", "")] * 4000,
        "system and blanks": [("system", "s."), *[("user", "")] * 4000],
        "one parity": [("system", "s."), *[("assistant" if i % 2 == 0 else "user", f"{i}") for i in range(4000)]],
        "random": [(rng.choice(["user", "assistant", "system"]), f"{i}{rng.choice(['.', ''])}") for i in range(4000)],
        "runs of users": [("user" if i % 9 else "assistant", f"{i}.") for i in range(4000)],
    }[kind]
    got, most = streamed(rows)
    assert most <= 64 and len([e for e in got[1] if e != "I"]) == len(rows)


def test_one_speaker_stays_open_to_the_end():
    for n in (100, 101):
        rows = [("user", f"{i}.") for i in range(n)]
        got, most = streamed(rows)
        assert got == repaired_by_force(rows) and most >= n


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def repairs_by_force(rows):
    convs = defaultdict(list)
    for r in damaged(rows):
        convs[r[0]].append(r)
    out = []
    for conv in {r[0] for r in rows}:
        mine = sorted(convs[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        turns = {r[1] for r in mine if r[1] is not None}
        faults = [f for _, _, f in told([r[2:] for r in mine])]
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:], strict=False))
        cost, audit, lines = repaired_by_force([r[2:] for r in mine])
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.fixture(scope="module")
def turns(spark):
    rng = random.Random(7)
    rows = [(c, t, *x) for c in range(-6, 60) for t, x in enumerate(any_turns(rng, rng.randrange(9)))]
    rows += [(100, None, "user", "hi."), (100, None, None, None), (100, 3, "user", "hi."), (100, 3, "user", "hi."), (100, 3, "assistant", "x"), (None, 1, "user", "q?"), (None, 2, "assistant", None)]
    rows += [(101, t, "user" if t % 2 == 0 else "assistant", "same.") for t in range(40)] + [(102, t, ("user", "assistant")[t % 2], f"{'long ' * 9000}{t}.") for t in range(7)]
    # The damage drops the only turn.
    rows += [(c, 0, "user", "gone.") for c in range(200, 400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    return rows, spark.createDataFrame([(*r, "x", 1.0) for r in rows], "conv_id long, turn long, role string, text string, times string, later double").repartition(5)


def test_repairs_of_odd_turns(turns):
    rows, df = turns
    got = conversation_repair.repair_damaged(df).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == repairs_by_force(rows)
    assert conversation_repair.repair_damaged(df.limit(0)).count() == 0


def test_edits_are_the_repaired_conversations(turns):
    rows, df = turns
    got = defaultdict(list)
    for r in conversation_repair.edits(df).orderBy("conv_id", "position").collect():
        got[r["conv_id"]].append(r)
    for conv in {r[0] for r in rows}:
        mine = sorted(((r[1], *(" " if x is None else x for x in r[2:])) for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))
        _, audit, lines = repaired_by_force([r[1:] for r in mine])
        assert "".join(r["edit"] * r["times"] for r in got[conv]) == audit
        assert tuple(f"{r['role']}:{r['text']}" for r in got[conv] if r["edit"] != "D") == lines


def trie_by_force(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(x)] for c, x in convs.items()}
    new = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        new[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, s in new.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    at = {p: min(m) for p, m in members.items()}
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        worth = (len(m) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += worth
    ends = defaultdict(list)
    for c, s in new.items():
        ends[s].append(c)
    return sorted(((at[p], len(p), at[p[:-1]] if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items()), key=repr)


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(8)
    return [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "", None, "ü"])) for c in range(-12, 70) for t in range(rng.randrange(7))]


def trie_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, name string, depth int").repartition(5)


@pytest.mark.parametrize("chunk", [1 << 16, 7])
def test_trie_of_odd_turns(spark, talks, chunk, monkeypatch):
    monkeypatch.setattr(conversation_trie, "CHUNK", chunk)
    rows = [*talks, (None, 1, "user", "x"), (100, None, "user", "n"), (100, None, "user", "n"), (100, 2, "user", "z"), (100, 2, "assistant", "y"), (10**15, 1, "user", "far"), (5, 3, "user", "3" * 100_000)]
    # Copies, so that most pieces lie below one cut prefix.
    rows += [(c, t, "user", f"same {t}") for c in range(1000, 1200) for t in range(12 + c % 3)]
    got = conversation_trie.trie_of_rebuilt(trie_frame(spark, rows)).select(*NODE).collect()
    assert sorted(map(tuple, got), key=repr) == trie_by_force(rows)


def test_trie_of_a_deep_conversation_and_of_none(spark):
    rows = [(c, t, "user", f"{t % 7}") for c in (3, 5, 10) for t in range(150 + c)] + [(7, t, "user", "q") for t in range(33)]
    df = trie_frame(spark, rows)
    got = conversation_trie.trie_of_rebuilt(df).select(*NODE).collect()
    assert sorted(map(tuple, got), key=repr) == trie_by_force(rows)
    assert conversation_trie.trie_of_rebuilt(df.limit(0)).count() == 0
    one = conversation_trie.trie_of_rebuilt(df.where("conv_id = 7 and turn = 0")).select(*NODE).collect()
    assert sorted(map(tuple, one), key=repr) == trie_by_force([(7, 0, "user", "q")])


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def chained(parts):
    """Spark's xxhash64 of values given as bytes: each is hashed with the hash so far as its seed."""
    h = 42
    for p in parts:
        h = xxhash.xxh64_intdigest(p, seed=h)
    return signed(h)


def print_by_force(text, k, take, sketches):
    """Each sketch: the `take` numbered k-mers whose ranks come next after its point on the ring, in text order."""
    long, bits = lambda x: struct.pack("<q", x), order_minhash.BITS
    words = [signed(xxhash.xxh64_intdigest(w.encode(), seed=42)) for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    seen, ranks = defaultdict(int), []
    for i in range(max(len(words) - k, 0) + 1):
        name = chained(map(long, words[i : i + k])) >> bits
        ranks.append((chained([long(name), struct.pack("<i", seen[name])]) >> bits, i))
        seen[name] += 1
    out = []
    for j in range(sketches):
        point = (-(1 << 63) + ((1 << 64) * j // sketches)) >> bits
        near = sorted(ranks, key=lambda r: ((r[0] - point) % (1 << 64 - bits), r[1]))
        taken = sorted((near[t % len(near)] for t in range(take)), key=lambda r: (r[1], r[0] % (1 << 36)))
        out.append(f"{chained(long(r % (1 << 36)) for r, _ in taken) % (1 << 16):04x}")
    return "".join(out)


@pytest.mark.parametrize("k,take,sketches", [(5, 2, 64), (1, 3, 7)])
def test_fingerprints_equal_brute_force(spark, k, take, sketches):
    rng = random.Random(9)
    texts = [" ".join(rng.choice("the of and to in üb ß 火".split()) + str(rng.randrange(9)) for _ in range(rng.randrange(80))) for _ in range(40)]
    texts += [None, "", " \n\t", "one", "one two", "x " * 3000, "a  b\nc\td e f", "a b c d e f", "same line here\n" * 30, "🙂🙂🙂🙂🙂"]
    rows = [(i * 3 - 20, t) for i, t in enumerate(texts)] + [(None, "no id but words"), (7_000_000_000, texts[0]), (7_000_000_000, texts[0]), (7_000_000_001, texts[0])]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, id string, head string").repartition(4)
    got = order_minhash.compare_edited(df, k=k, take=take, sketches=sketches).collect()
    known = {i: t or "" for i, t in rows if i is not None}
    after = dict(zip(sorted(known), [*sorted(known)[1:], min(known)], strict=True))
    want = []
    for i, t in rows:
        t = t or ""
        head = known[after[i]] if i is not None else ""
        edited = t[: len(t) - len(t) // 2] + head[: len(t) // 2]
        own, other, following = (print_by_force(x, k, take, sketches) for x in (t, edited, head))
        like = lambda a, b: sum(a[j : j + 4] == b[j : j + 4] for j in range(0, len(a), 4)) / sketches
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), own, other, like(own, other), like(own, following) if i is not None else 0.0))
    names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    assert sorted((tuple(r[n] for n in names) for r in got), key=repr) == sorted(want, key=repr)
    assert order_minhash.compare_edited(df.limit(0)).count() == 0


def test_likeness_follows_edits_and_order(spark):
    rng = random.Random(10)
    words = [f"w{rng.randrange(5000)}" for _ in range(600)]
    variants = {"same": words, "one edit": [*words[:300], "new", *words[301:]], "tenth": [w if i % 50 >= 5 else "z" + w for i, w in enumerate(words)], "turned": words[300:] + words[:300], "other": [f"v{i}" for i in range(600)]}
    df = spark.createDataFrame([(n, " ".join(w)) for n, w in variants.items()], "n string, t string")
    prints = {r["n"]: bytes(r["p"]).hex() for r in order_minhash.sketched(df, {"p": "t"}, sketches=512).collect()}
    like = {n: sum(prints["same"][j : j + 4] == p[j : j + 4] for j in range(0, 2048, 4)) / 512 for n, p in prints.items()}
    assert like["same"] == 1 and like["one edit"] > 0.9 > like["tenth"] > 0.4 and like["other"] == 0
    # The same k-mers in another order: a set of them would hardly tell the two apart.
    assert 0.3 < like["turned"] < 0.7
