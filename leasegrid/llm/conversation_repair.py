"""Cheapest repair of damaged conversations by a Viterbi that streams: survivors' edits are emitted once all of them share an ancestor.

Turns are read in order. The states are what the repaired conversation ends with so far: nothing, a system turn, a user turn or an
assistant turn. Each state's survivor is a leaf of a tree of edits with back pointers and reference counts. A step that loses frees
the branch that only it held; what is left as the one branch below the root is emitted and freed. A state goes once another can do
at less cost whatever it can. Ties between survivors of one state are settled by all their edits after the last common one: as edits
of equal cost are never one a beginning of the other, the least beginning stays the least. Runs of deletions are one node, so memory
holds the edits still open. Those are few where speakers alternate at all; in a run of turns of one speaker the number of turns decides
at its end which of two repairs is cheaper, and both stay open until then.

Turns of one conversation meet sorted in one task as a stream, as the digest of the repaired text can't be made in parts; copies of a
turn are counted before that, and repeated texts are found by aggregation before that, so the stream holds no set of seen texts.

Defined results: a null role or text is one space; turns are in order of (turn, nulls first; role; text); a null conv_id is one
conversation; equal rows are duplicates of the first of them; roles are told apart by their first character, as written, and any other
than s, u or a has to be deleted or given a new role; an empty table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leasegrid.llm.shared import join_hot, written

SPACE = " \t\n\x0b\x0c\r"
NONE, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
#: At most how much more it costs to go on from the first state than from the second, whatever comes.
BEHIND = {
    (NONE, SYSTEM): 0, (NONE, USER): 2, (NONE, ASSISTANT): 0, (SYSTEM, NONE): 4, (SYSTEM, USER): 2, (SYSTEM, ASSISTANT): 4,
    (USER, NONE): 5, (USER, SYSTEM): 2, (USER, ASSISTANT): 2, (ASSISTANT, NONE): 3, (ASSISTANT, SYSTEM): 0, (ASSISTANT, USER): 2,
}
DIGEST = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
EDITS = "conv_id long, position long, edit string, times long, role string, text string"


class _Edit:
    """A node of the tree: `times` equal deletions, or one other edit. refs: its children, and one more for a survivor that ends here."""

    __slots__ = ("letter", "refs", "role", "text", "times", "up")

    def __init__(self, up, letter, times=1, role=None, text=None):
        self.up, self.letter, self.times, self.role, self.text, self.refs = up, letter, times, role, text, 0


def _open(leaf, root) -> list[list]:
    """[letter, times] of the edits between root and leaf, in order."""
    out = []
    while leaf is not root:
        out.append([leaf.letter, leaf.times])
        leaf = leaf.up
    return out[::-1]


def _before(a: list[list], b: list[list]) -> bool:
    """Whether the first text of letters is less than the second, in ASCII."""
    a, b = [list(x) for x in a], [list(x) for x in b]
    i = j = 0
    while i < len(a) and j < len(b):
        if a[i][0] != b[j][0]:
            return a[i][0] < b[j][0]
        n = min(a[i][1], b[j][1])
        a[i][1] -= n
        b[j][1] -= n
        i, j = i + (not a[i][1]), j + (not b[j][1])
    return i == len(a) and j < len(b)


class Repair:
    """One conversation's turns in order into `turn`, edits out of it and of `end`, as (letter, times, role, text)."""

    def __init__(self):
        self.root = _Edit(None, "")
        self.root.refs = 1
        self.held = {NONE: (0, self.root)}

    def _best(self, found: dict, state: int, cost: int, leaf, more: tuple) -> None:
        if (have := found.get(state)) is None or cost < have[0]:
            found[state] = (cost, leaf, more)
        elif cost == have[0]:
            mine, other = (_open(x, self.root) + [[m[0], 1] for m in y] for x, y in ((leaf, more), have[1:]))
            if _before(mine, other):
                found[state] = (cost, leaf, more)

    def _drop(self, leaf) -> None:
        leaf.refs -= 1
        while not leaf.refs and leaf is not self.root:
            leaf = leaf.up
            leaf.refs -= 1

    def _settle(self, found: dict) -> list[tuple]:
        """Makes what was found the survivors and returns what all of them now share."""
        costs = {s: x[0] for s, x in found.items()}
        found = {s: x for s, x in found.items() if all(costs[s] <= c + BEHIND[o, s] for o, c in costs.items() if o != s)}
        used = [x[1] for x in found.values()]
        held = {}
        for state, (cost, leaf, more) in found.items():
            if len(more) == 1 and more[0][0] == "D" and leaf.letter == "D" and leaf is not self.root and leaf.refs == 1 and sum(x is leaf for x in used) == 1:
                leaf.times += more[0][1]
            else:
                for m in more:
                    leaf.refs += 1
                    leaf = _Edit(leaf, *m)
            leaf.refs += 1
            held[state] = (cost, leaf)
        for _, leaf in self.held.values():
            self._drop(leaf)
        self.held = held
        # The one branch below the root, as far as it is one.
        if self.root.refs > 1:
            return []
        path, at = [], next(iter(held.values()))[1]
        while at is not self.root:
            path.append(at)
            at = at.up
        out, ends = [], {id(leaf) for _, leaf in held.values()}
        while path and self.root.refs == 1 and id(self.root) not in ends:
            self.root = path.pop()
            self.root.up = None
            out.append((self.root.letter, self.root.times, self.root.role, self.root.text))
            self.root.text = None
        return out

    def turn(self, role: str, text: str, must_go: int, stays: bool, truncated: bool) -> list[tuple]:
        """One turn that may stay (`stays`), then `must_go` copies of it, or turns like it, that have to be deleted."""
        out = []
        if stays:
            found: dict = {}
            first, more = role[:1], TRUNCATED if truncated else 0
            for state, (cost, leaf) in self.held.items():
                self._best(found, state, cost + DELETE, leaf, (("D", 1),))
                # Inserts count before what stays only: before a deletion they are never the least. Three in a row are never cheapest.
                put: tuple = ()
                for n in range(3):
                    after = ASSISTANT if state == USER else USER
                    if first == "s" and state == NONE:
                        self._best(found, SYSTEM, cost + more, leaf, (("K", 1, role, text),))
                    if first == ROLES[after][0]:
                        self._best(found, after, cost + INSERT * n + more, leaf, (*put, ("K", 1, role, text)))
                    self._best(found, after, cost + INSERT * n + REROLE + more, leaf, (*put, ("R", 1, ROLES[after], text)))
                    put, state = (*put, ("I", 1, ROLES[after], "")), after
            out += self._settle(found)
        if must_go:
            out += self._settle({s: (cost + DELETE * must_go, leaf, (("D", must_go),)) for s, (cost, leaf) in self.held.items()})
        return out

    def end(self) -> tuple[int, list[tuple]]:
        """The cost, and the edits not emitted yet."""
        found: dict = {}
        user, assistant = ("I", 1, ROLES[USER], ""), ("I", 1, ROLES[ASSISTANT], "")
        for state, (cost, leaf) in self.held.items():
            more = {SYSTEM: (user, assistant), USER: (assistant,)}.get(state, ())
            self._best(found, NONE, cost + INSERT * len(more), leaf, more)
        out = self._settle(found)
        cost, leaf = self.held[NONE]
        if leaf is not self.root:
            raise AssertionError("the last survivor has to be the root")
        return cost, out


def _streamed(batches):
    """(conv_id, turn, role, text, times, stays, must go, blank, truncated) of each distinct turn of sorted batches, None between conversations."""
    last, begun = None, False
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            conv, turn, role, text, times, later = row
            if begun and conv != last:
                yield None
            last, begun = conv, True
            kept = text.rstrip(SPACE)
            stays = bool(kept) and not later
            yield conv, turn, role, text, times, stays, times - stays, not kept, stays and kept[-1] not in ".!?"
    if begun:
        yield None


def _packed(rows, schema, size=4096):
    names = [x.split(" ")[0] for x in schema.split(", ")]
    kinds = [pa.int64() if x.endswith("long") else pa.string() for x in schema.split(", ")]
    for i in range(0, len(rows), size):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i : i + size], strict=True), kinds, strict=True)], names=names)


def _digests(batches):
    made, now = [], None
    for row in _streamed(batches):
        if row is None:
            cost, out = now["repair"].end()
            _hashed(now, out)
            low, high, n = now["low"], now["high"], now["turns"]
            made.append((now["conv"], high - low + 1 - n if n else 0, now["blank"], now["duplicate"], now["truncated"], now["illegal"], cost, "".join(now["audit"]), now["sha"].hexdigest()))
            now = None
            if len(made) >= 1024:
                yield from _packed(made, DIGEST)
                made = []
            continue
        conv, turn, role, text, times, stays, go, blank, truncated = row
        if now is None:
            now = {"conv": conv, "repair": Repair(), "low": None, "high": None, "turns": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "role": None, "audit": [], "sha": hashlib.sha256(), "any": False}
        if turn is not None and turn != now["high"]:
            now["low"], now["high"], now["turns"] = turn if now["low"] is None else now["low"], turn, now["turns"] + 1
        now["blank" if blank else "duplicate"] += go
        now["truncated"] += truncated
        now["illegal"] += times - 1 + (now["role"] is not None and now["role"] + role[:1] not in ("su", "ua", "au"))
        now["role"] = role[:1]
        _hashed(now, now["repair"].turn(role, text, go, stays, truncated))
    yield from _packed(made, DIGEST)


def _hashed(now: dict, edits: list[tuple]) -> None:
    for letter, times, role, text in edits:
        now["audit"].append(letter * times)
        if letter != "D":
            now["sha"].update((("\n" if now["any"] else "") + f"{role}:{text}").encode())
            now["any"] = True


def _edit_rows(batches):
    made, size, repair, conv, at = [], 0, None, None, 0
    for row in _streamed(batches):
        if row is None:
            out, repair = repair.end()[1], None
        else:
            if repair is None:
                repair, conv, at = Repair(), row[0], 0
            out = repair.turn(row[2], row[3], row[6], row[5], row[8])
        for letter, times, role, text in out:
            made.append((conv, at, letter, times, role, text))
            at, size = at + 1, size + len(text or "")
        if len(made) >= 4096 or size > 4 << 20:
            yield from _packed(made, EDITS)
            made, size = [], 0
    yield from _packed(made, EDITS)


def _ordered(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, times, later) of each distinct turn, each conversation sorted in one partition; later: the same was said before."""
    filled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    each = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *filled)
    each = each.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("times"))
    said = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.length("role").cast("string"), "role", "text")
    each = written(each.withColumn("said", F.unhex(F.substring(F.sha2(said, 256), 1, 32))), "turns")
    often = each.groupBy("said").agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    marked = join_hot(each, often, "said", "n", each.count(), "left")
    later = F.coalesce(F.col("turn") > F.col("first.turn"), F.col("turn").isNotNull() & F.col("first").isNotNull() & F.col("first.turn").isNull())
    rows = marked.select("conv_id", "turn", "role", "text", "times", later.alias("later"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")


def edits(turns: DataFrame) -> DataFrame:
    """(conv_id, position, edit, times, role, text): the cheapest edits of each conversation in order; role and text are what a turn reads after it, null if deleted.

    turns: conv_id, turn, role, text. The turns with a role, in order of position, are the repaired conversation.
    """
    return _ordered(turns).mapInArrow(_edit_rows, EDITS)


def digests(turns: DataFrame) -> DataFrame:
    """A row for each conversation of turns: its faults, and cost, audit letters and SHA-256 of its repair."""
    return _ordered(turns).mapInArrow(_digests, DIGEST)


def damaged(turns: DataFrame) -> DataFrame:
    """turns with faults put in by the checksum of conversation and turn: some dropped, emptied, left without their ends, repeated, or given to the user."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = turns.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    new = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), new.alias("text"), copies.alias("copy")).drop("copy")


def repair_damaged(turns: DataFrame) -> DataFrame:
    """digests of the damaged turns, with a row for every conversation of the undamaged ones."""
    found = digests(damaged(turns)).withColumnRenamed("conv_id", "_conv")
    names = turns.groupBy(F.col("conv_id").cast("long").alias("conv_id")).count().select("conv_id")
    rows = names.join(found.hint("shuffle_hash"), names["conv_id"].eqNullSafe(found["_conv"]), "left").drop("_conv")
    zeros = dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0)
    return rows.fillna(zeros | {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()})
