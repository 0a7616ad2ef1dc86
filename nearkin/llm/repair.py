"""Conversation structure repair: the cheapest edits that give every conversation a legal order of roles.

What a row is takes one byte: its role's initial and its fault. Only these bytes go through one
place in order, conversation by conversation, where a Viterbi search over four states finds the
edits; texts stay where they are, sorted over all tasks, and the edits come back to them by place.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearkin.session import stored

# Costs of the edits, and which initials may stand side by side.
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
LEGAL_PAIRS = ("su", "ua", "au")
#: What a row may be: fine, cut off, without text, said before.
FINE, CUT, BLANK, DUPLICATE = range(4)
INITIALS = "suax"
ROLES = {"u": "user", "a": "assistant"}
#: States: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
NEXT_ROLE = "uuau"
#: By state q and p: what the cheapest rest from q costs at most above that from p. After an
#: assistant, all that is left can be done as after nothing but for a system row, which is deleted
#: then; as after a system row; and, with an insert, as after a user. The others follow likewise.
BEHIND = {
    START: {SYSTEM: 0, USER: INSERT, ASSISTANT: 2 * INSERT},
    SYSTEM: {START: 2 * INSERT, USER: INSERT, ASSISTANT: 2 * INSERT},
    USER: {START: INSERT + DELETE, SYSTEM: INSERT, ASSISTANT: INSERT},
    ASSISTANT: {START: DELETE, SYSTEM: 0, USER: INSERT},
}
#: Edits that end a conversation in each state, with their cost.
TAILS = {START: ("", "", 0), SYSTEM: ("II", "ua", 2 * INSERT), USER: ("I", "a", INSERT), ASSISTANT: ("", "", 0)}
#: Consecutive rows of a conversation that travel as one string; a power of two.
CHUNK_BITS = 12
#: Code points of a text by which rows of one turn and role are ordered before their digests.
HEAD_CHARS = 256
OUT_ROWS = 20_000


def _edits_of(initial: str, fault: int, state: int) -> dict[int, tuple[int, str, str]]:
    """Of each state that a row may lead to: the cost, edits and roles of the best way there."""
    best: dict[int, tuple[int, str, str]] = {}
    cost, letters, roles, at = 0, "", "", state
    for _ in range(3):
        ways = [(at, cost + DELETE, "D", "-")]
        if fault in (FINE, CUT):
            extra = cost + (TRUNCATED if fault == CUT else 0)
            if (at, initial) in AFTER:
                ways.append((AFTER[at, initial], extra, "K", initial))
            if NEXT_ROLE[at] != initial:
                ways.append((AFTER[at, NEXT_ROLE[at]], extra + REROLE, "R", NEXT_ROLE[at]))
        for to, sum_, letter, role in ways:
            way = (sum_, letters + letter, roles + role)
            if to not in best or way < best[to]:
                best[to] = way
        cost, letters, roles, at = cost + INSERT, letters + "I", roles + NEXT_ROLE[at], AFTER[at, NEXT_ROLE[at]]
    return best


def code_of(initial: str, fault: int) -> str:
    return chr(65 + 4 * INITIALS.index(initial) + fault)


#: By code of a row and state: the ways on.
WAYS = {
    code_of(initial, fault): [list(_edits_of(initial, fault, state).items()) for state in range(4)]
    for initial in INITIALS for fault in range(4)
}


class Node:
    """One row's edits on the path of a survivor; ``refs`` are the nodes that go on from here."""

    __slots__ = ("parent", "letters", "roles", "refs")

    def __init__(self, parent: Node | None, letters: str, roles: str):
        self.parent, self.letters, self.roles, self.refs = parent, letters, roles, []


def _is_less(one: Node, letters: str, other: Node, other_letters: str) -> bool:
    """Whether the edits on one path come before those on another of as many rows.

    Both are read back to where they part. Equal costs over equally many rows mean that neither
    is a beginning of the other, so what comes later cannot turn the comparison.
    """
    a, b = [letters], [other_letters]
    while one is not other:
        a.append(one.letters)
        b.append(other.letters)
        one, other = one.parent, other.parent
    return "".join(reversed(a)) < "".join(reversed(b))


class Search:
    """Viterbi over one conversation's rows, giving out edits as soon as all survivors share them."""

    def __init__(self):
        self.root = Node(None, "", "")
        self.live: dict[int, tuple[int, Node]] = {START: (0, self.root)}

    def step(self, code: str) -> Iterator[tuple[str, str]]:
        """Take one row; the edits and roles of the rows that are now decided, oldest first."""
        found: dict[int, tuple[int, Node, str, str]] = {}
        ways = WAYS[code]
        for state, (so_far, node) in self.live.items():
            for to, (extra, letters, roles) in ways[state]:
                cost, held = so_far + extra, found.get(to)
                if held is None or cost < held[0] or (cost == held[0] and _is_less(node, letters, held[1], held[2])):
                    found[to] = (cost, node, letters, roles)
        ended = [node for _, node in self.live.values()]
        self.live = {}
        for to, (cost, node, letters, roles) in found.items():
            # A survivor that cannot win, such as all rows deleted, would keep the others apart.
            if any(cost > other[0] + BEHIND[state][to] for state, other in found.items() if state != to):
                continue
            own = Node(node, letters, roles)
            node.refs.append(own)
            self.live[to] = (cost, own)
        for node in ended:
            while not node.refs and node is not self.root:
                node.parent.refs.remove(node)
                node, gone = node.parent, node
                gone.parent = None
        while len(self.root.refs) == 1:
            self.root = self.root.refs[0]
            self.root.parent.refs.clear()
            self.root.parent = None
            yield self.root.letters, self.root.roles

    def finish(self) -> tuple[int, list[tuple[str, str]], str, str]:
        """The cost, the edits of the rows still open, and the inserts at the end."""
        best = None
        for state, (cost, node) in self.live.items():
            letters, roles, extra = TAILS[state]
            if best is None or cost + extra < best[0] or (
                cost + extra == best[0] and _is_less(node, letters, best[1], best[2])
            ):
                best = (cost + extra, node, letters, roles)
        cost, node, letters, roles = best
        rest = []
        while node is not self.root:
            rest.append((node.letters, node.roles))
            node = node.parent
        return cost, rest[::-1], letters, roles


def _key(conv: Column) -> Column:
    """A conversation's id as a string that no other has; nulls have one too."""
    return F.when(conv.isNull(), "n").otherwise(F.concat(F.lit("v"), conv.cast("string")))


def _id(key: str, kind: str) -> Column:
    return F.when(F.col(key) == "n", F.lit(None)).otherwise(F.substring(key, 2, 1 << 30)).cast(kind)


def ordered(conversations: DataFrame) -> DataFrame:
    """``conv, turn, role, text, mark, blank, ended, initial, place`` of all rows, stored in order.

    Null roles and texts are one space. Rows of a conversation go by turn, nulls first, then by
    role, the first HEAD_CHARS of the text, and its digest. They are parted by ranges of all of
    these and, at last, of a row number, so that a conversation or a repeated row that a third
    of the table has lies in many tasks. ``place`` grows along this order.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    rows = stored(
        conversations.select(
            _key(F.col("conv_id")).alias("conv"), F.col("turn").cast("long").alias("turn"),
            role.alias("role"), text.alias("text"),
        ).withColumns({
            "head": F.substring("text", 1, HEAD_CHARS),
            "mark": F.unhex(F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256)),
            "row": F.monotonically_increasing_id(),
        }),
        "repair-rows",
    )
    order = ["conv", "turn", "role", "head", "mark", "row"]
    initial = F.substring("role", 1, 1)
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", "turn", "role", "text", "mark",
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z").alias("ended"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
        F.monotonically_increasing_id().alias("place"),
    )
    return stored(sorted_, "repair-ordered")


def _chunks(rows: DataFrame) -> DataFrame:
    """``conv, chunk, codes, places``: the rows' codes, at most 2^CHUNK_BITS in one string.

    A row that says what an earlier one said is a duplicate: the earliest place of a role and
    text is found with a map-side combine, and joined back by place, which no two rows share.
    """
    slim = rows.select("conv", "place", "mark", "blank", "ended", "initial")
    firsts = (
        slim.filter(~F.col("blank")).groupBy("conv", "mark").agg(F.min("place").alias("place"))
        .select("place", F.lit(True).alias("first"))
    )
    fault = (
        F.when(F.col("blank"), BLANK).when(F.col("first").isNull(), DUPLICATE).when(~F.col("ended"), CUT).otherwise(FINE)
    )
    code = F.char(65 + 4 * (F.instr(F.lit(INITIALS), F.col("initial")) - 1) + fault)
    coded = slim.join(firsts, "place", "left").select(
        "conv", F.shiftright("place", CHUNK_BITS).alias("chunk"), F.struct("place", code.alias("code")).alias("row")
    )
    packed = coded.groupBy("conv", "chunk").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    return packed.select("conv", "chunk", F.array_join("rows.code", "").alias("codes"), F.col("rows.place").alias("places"))


def _counted(codes: str, before: str) -> tuple[list[int], str]:
    """Blank, duplicate, truncated rows and illegal neighbours of a chunk, and its last initial."""
    faults, initials = [0, 0, 0, 0], before
    for code in codes:
        n = ord(code) - 65
        faults[n % 4] += 1
        initials += INITIALS[n // 4]
    illegal = sum(initials[i : i + 2] not in LEGAL_PAIRS for i in range(len(initials) - 1))
    return [faults[BLANK], faults[DUPLICATE], faults[CUT], illegal], initials[-1:]


TOTALS = ("blank", "duplicate", "truncated", "illegal", "cost")
DECODED = pa.schema(
    [
        ("conv", pa.string()), ("places", pa.list_(pa.int64())), ("letters", pa.list_(pa.string())),
        ("roles", pa.list_(pa.string())), *[(name, pa.int64()) for name in TOTALS],
    ]
)


def decode_chunks(chunks: Iterator[tuple[str, str, list[int]]]) -> Iterator[tuple]:
    """Of chunks in order: their rows' edits, and the totals of a conversation with its last chunk.

    What is held is the open part of one conversation: the chunks that reach back to the first row on
    which survivors differ.
    """
    conv, search, waiting, decided = None, Search(), deque(), deque()
    totals, last = [0] * 4, ""

    def ready(tail: tuple[str, str] | None = None, cost: int | None = None) -> Iterator[tuple]:
        while waiting and len(decided) >= len(waiting[0]):
            places = waiting.popleft()
            rows = [decided.popleft() for _ in places]
            ends = tail is not None and not waiting
            if ends:
                rows[-1] = (rows[-1][0] + tail[0], rows[-1][1] + tail[1])
            letters, roles = zip(*rows, strict=True)
            yield (conv, places, letters, roles, *((*totals, cost) if ends else (None,) * 5))

    def end() -> Iterator[tuple]:
        if conv is not None:
            cost, rest, letters, roles = search.finish()
            decided.extend(rest)
            # The end's inserts and the totals go with the last chunk, even where it was complete.
            yield from ready((letters, roles), cost)

    for key, codes, places in chunks:
        if key != conv:
            yield from end()
            conv, search, totals, last = key, Search(), [0] * 4, ""
        else:
            yield from ready()
        waiting.append(places)
        found, last = _counted(codes, last)
        totals = [a + b for a, b in zip(totals, found, strict=True)]
        for code in codes:
            decided.extend(search.step(code))
    yield from end()


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def chunks():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("conv", "codes", "places")), strict=True)

    held, n = [], 0
    for row in decode_chunks(chunks()):
        held.append(row)
        n += len(row[1])
        if n >= OUT_ROWS:
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip(zip(*held, strict=True), DECODED, strict=True)], schema=DECODED
            )
            held, n = [], 0
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, f.type) for v, f in zip(zip(*held, strict=True), DECODED, strict=True)], schema=DECODED
        )


def find_edits(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of the result of ``ordered``: ``place, letters, roles`` of every row, and totals by conversation.

    ``letters`` are the edits at a row in order, of K (keep), R (rerole), D (delete) and I (insert),
    inserts of the end at the last row; ``roles`` are the initials they give, "-" for D. The edits
    of a conversation are the cheapest, of equally cheap ones those least in ASCII order. Totals
    are ``conv, blank, duplicate, truncated, illegal, cost``.
    """
    decoded = stored(
        _chunks(rows).repartition("conv").sortWithinPartitions("conv", "chunk").mapInArrow(
            _decode,
            "conv string, places array<long>, letters array<string>, roles array<string>, "
            + ", ".join(f"{name} long" for name in TOTALS),
        ),
        "repair-edits",
    )
    edits = decoded.select(F.explode(F.arrays_zip("places", "letters", "roles")).alias("e")).select(
        F.col("e.places").alias("place"), F.col("e.letters").alias("letters"), F.col("e.roles").alias("roles")
    )
    return edits, decoded.filter(F.col("cost").isNotNull()).select("conv", *TOTALS)


def repaired(conversations: DataFrame) -> DataFrame:
    """``conv_id, place, nth, edit, role, text``: all rows that stay or are inserted, with their edit.

    ``place`` and ``nth`` give the order within a conversation. Conversations of which nothing is
    left have no row. Rows are faulty that have no text but white space, that repeat a role and text
    (both are deleted), or whose last character that is no white space is none of ``.!?``. Null
    conversation ids are one conversation; long texts only move with the sort; columns other than
    ``conv_id, turn, role, text`` are left out; an empty table gives an empty one.
    """
    rows = ordered(conversations)
    edits, _ = find_edits(rows)
    kind = conversations.schema["conv_id"].dataType.simpleString()
    each = rows.join(edits, "place").select("conv", "place", "role", "text", "roles", F.posexplode(F.split("letters", "")).alias("nth", "edit"))
    given = F.when(F.substring("roles", F.col("nth") + 1, F.lit(1)) == "u", ROLES["u"]).otherwise(ROLES["a"])
    return each.filter(F.col("edit").isin("K", "R", "I")).select(
        _id("conv", kind).alias("conv_id"), "place", "nth", "edit",
        F.when(F.col("edit") == "K", F.col("role")).otherwise(given).alias("role"),
        F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias("text"),
    )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest and audit a conversation, over rows that come in order."""
    names = ["conv", "audit", "repaired_sha256"]
    conv, digest, audit, any_ = None, hashlib.sha256(), [], False
    done: list[tuple[str, str, str]] = []
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("conv", "role", "text", "letters", "roles"))
        for key, role, text, letters, roles in zip(*columns, strict=True):
            if key != conv:
                if conv is not None:
                    done.append((conv, "".join(audit), digest.hexdigest()))
                conv, digest, audit, any_ = key, hashlib.sha256(), [], False
            audit.append(letters)
            for letter, initial in zip(letters, roles, strict=True):
                if letter != "D":
                    line = f"{role if letter == 'K' else ROLES[initial]}:{'' if letter == 'I' else text}"
                    digest.update((("\n" if any_ else "") + line).encode())
                    any_ = True
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.string()) for v in zip(*done, strict=True)], names=names)
            done = []
    if conv is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], pa.string()) for v in (conv, "".join(audit), digest.hexdigest())], names=names
        )


def summary(conversations: DataFrame, ids: DataFrame) -> DataFrame:
    """One row for every ``conv_id`` of ``ids``: its gaps, faults, cost, edits and repaired digest.

    Columns: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.
    The digest covers the repaired ``role:text`` lines and so reads a conversation's texts one
    after the other, row by row. A conversation without rows has zeros and nothing to hash.
    """
    rows = ordered(conversations)
    edits, totals = find_edits(rows)
    lines = rows.select("conv", "place", "role", "text").join(edits, "place")
    hashed = lines.repartition("conv").sortWithinPartitions("conv", "place").mapInArrow(
        _hashed, "conv string, audit string, repaired_sha256 string"
    )
    turns = rows.select("conv", "turn").filter("turn IS NOT NULL").distinct()
    gaps = turns.groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    kind = ids.schema["conv_id"].dataType.simpleString()
    every = ids.select(_key(F.col("conv_id")).alias("conv")).distinct()
    found = every.join(totals, "conv", "left").join(gaps, "conv", "left").join(hashed, "conv", "left")
    return found.select(
        _id("conv", kind).alias("conv_id"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", *TOTALS)],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults put in by a checksum of ``conv_id:turn``: dropped, emptied, cut, repeated or given to the user.

    Null roles, texts and, in the checksum, ids and turns are one space.
    """
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), F.lit(" ")),
    )
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("text", "role"))
    fate = F.crc32(key) % 20
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), fate.alias("fate")).filter("fate != 0")
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("fate") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")
