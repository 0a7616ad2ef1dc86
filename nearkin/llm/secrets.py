"""Secrets in documents: exact patterns, and a linear-chain conditional random field."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearkin.llm.arrow import LOWER, SPACES, batches_of_bytes, byte_table, chars_before, flat, hashes, mix, runs, tidied
from nearkin.llm.columns import text_or_empty
from nearkin.session import stored

# The exact patterns, in the order in which kinds are listed.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_VALUE_CHARS = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_CHARS = 20
HEX_CHARS = 24
KINDS = ("assign", "access", "hex")

LETTERS_LOWER = "abcdefghijklmnopqrstuvwxyz"
DIGITS = "0123456789"
HEX = byte_table(DIGITS + "abcdef")
#: Of every byte: 0 white space, 1 within values and words, 2 other punctuation.
CLASS = np.full(256, 2, dtype=np.uint8)
CLASS[SPACES] = 0
CLASS[byte_table(LETTERS_LOWER + LETTERS_LOWER.upper() + DIGITS + "+/_.-")] = 1
CLASS[128:] = 1
#: Flags of a token's bytes: lower case, upper case, digit, other.
FLAGS = np.full(256, 8, dtype=np.uint8)
FLAGS[byte_table(LETTERS_LOWER)] = 1
FLAGS[byte_table(LETTERS_LOWER.upper())] = 2
FLAGS[byte_table(DIGITS)] = 4
FLAGS[SPACES] = 0

#: Bytes of text that are looked at together: each takes some sixty bytes in tokens and sums.
SCAN_BYTES = 512 << 10
#: Rows whose windows train the model, and windows at most; both bound what training gathers.
TRAIN_ROWS = 20_000
TRAIN_WINDOWS = 3_000
#: Windows that one document gives to training at most, by kind, drawn by a hash over all its
#: places: around labelled spans, around other tokens with digits, around any other token.
SPANS_PER_DOC, DIGITS_PER_DOC, PLAIN_PER_DOC = 8, 4, 2
#: Labelled spans are also shown in other forms than the patterns know, this many times each.
FORMS_PER_SPAN = 4
#: Shares of the windows: labelled spans as they are, in other forms, and other places.
SHARES = {"span": 0.2, "form": 0.4, "other": 0.4}
#: Bytes to either side of a span that its other forms are shown with.
CONTEXT = 200
#: Tokens to either side of a training window's middle.
REACH = 20
ROUNDS = 100
#: Tags: outside, begin, inside.
N_TAGS = 3
WORD_BUCKETS = 1024
# Where each feature's values begin among the weights.
OWN_SHAPE, DETAIL, BEFORE, BEFORE2, SHAPE_BEFORE, SHAPE_AFTER, FILE, PADDING = np.cumsum(
    [0, 256, 64, WORD_BUCKETS, WORD_BUCKETS, 256, 256, 32]
).tolist()
N_FEATURES = PADDING + 1
N_PER_TOKEN = 7


@dataclass
class Tokens:
    """The tokens of several texts: where they are, whose they are, and their features."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    owner: np.ndarray
    features: np.ndarray
    file: np.ndarray


def tokens(data: np.ndarray, bounds: np.ndarray, file: np.ndarray | None = None) -> Tokens:
    """Runs of word characters and runs of punctuation, described by shape, neighbours and file.

    ``file`` tells what kind of file each text comes from, if the text is a part of one.
    """
    n_texts = len(bounds) - 1
    words, marks = runs(CLASS[data] == 1, bounds), runs(CLASS[data] == 2, bounds)
    starts = np.concatenate([words[0], marks[0]])
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.concatenate([words[1], marks[1]])[order]
    first = np.searchsorted(starts, bounds)
    owner = np.repeat(np.arange(n_texts), np.diff(first))
    if not len(starts):
        return Tokens(starts, ends, first, owner, np.zeros((0, N_PER_TOKEN), np.int32), np.zeros(n_texts, np.int32))
    sizes = ends - starts
    flags = FLAGS[data]
    kinds = np.bitwise_or.reduceat(flags, starts).astype(np.int32)
    mark = (CLASS[data[starts]] == 2).astype(np.int32)
    length = np.digitize(sizes, (2, 4, 8, 12, 16, 20, 32)).astype(np.int32)
    shape = kinds | (mark << 4) | (length << 5)

    def total(flag: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flag, dtype=np.int32)])
        return sums[ends] - sums[starts]

    n_digits = total(flags == 4)
    turns = np.zeros(len(data), dtype=bool)
    turns[1:] = (flags[1:] == 4) != (flags[:-1] == 4)
    # The turn at a token's first byte is not inside it.
    n_turns = total(turns) - turns[starts]
    all_hex = (total(HEX[data]) == sizes).astype(np.int32)
    detail = (
        np.digitize(n_digits, (1, 4, 8)) * 16 + np.digitize(n_turns, (1, 2, 4)) * 4 + all_hex * 2
        + (n_digits == sizes)
    ).astype(np.int32)
    names = (hashes(LOWER[data], starts, ends) % np.uint64(WORD_BUCKETS)).astype(np.int32)
    if file is None:
        counts = np.maximum(np.diff(first), 1)
        dense = np.digitize(np.bincount(owner, weights=n_digits > 0, minlength=n_texts) / counts, (0.001, 0.01, 0.05))
        dotted = np.bincount(owner, weights=mark, minlength=n_texts) / counts > 0.25
        file = (dense * 2 + dotted).astype(np.int32)
    in_file = file[owner] * 4 + (sizes >= 16) * 2 + (n_digits > 0)

    def shifted(values: np.ndarray, by: int, base: int) -> np.ndarray:
        out = np.full(len(values), PADDING, dtype=np.int32)
        if by > 0:
            same = owner[by:] == owner[:-by]
            out[by:][same] = base + values[:-by][same]
        else:
            same = owner[:by] == owner[-by:]
            out[:by][same] = base + values[-by:][same]
        return out

    features = np.stack(
        [
            OWN_SHAPE + shape, DETAIL + detail, shifted(names, 1, BEFORE), shifted(names, 2, BEFORE2),
            shifted(shape, 1, SHAPE_BEFORE), shifted(shape, -1, SHAPE_AFTER), (FILE + in_file).astype(np.int32),
        ],
        axis=1,
    )
    return Tokens(starts, ends, first, owner, features, file)


def exact_spans(text: str) -> list[tuple[str, int, int, int]]:
    """Kind, start, end, and start of the value of the spans of ASSIGN and ACCESS in a text."""
    found = []
    low = text.lower()
    if any(hint in low for hint in ASSIGN_HINTS):
        found += [
            ("assign", *m.span(), m.start(2))
            for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_VALUE_CHARS
        ]
    if "AKIA" in text:
        found += [("access", *m.span(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    return found


@dataclass
class Scanned:
    """Exact spans of several texts, in code points, with the byte and token view of the texts."""

    spans: list[list[tuple[str, int, int, int]]]
    tokens: Tokens
    chars: np.ndarray
    bounds: np.ndarray


def scan_texts(texts: pa.Array) -> Scanned:
    data, bounds = flat(texts)
    chars = chars_before(data)
    spans = [exact_spans(t) for t in texts.to_pylist()]
    starts, ends, first = runs(HEX[data], bounds)
    long = np.flatnonzero(ends - starts >= HEX_CHARS)
    owner = np.searchsorted(first, long, side="right") - 1
    for i, at in zip(owner.tolist(), long.tolist(), strict=True):
        base = chars[bounds[i]]
        a, b = int(chars[starts[at]] - base), int(chars[ends[at]] - base)
        spans[i].append(("hex", a, b, a))
    for found in spans:
        found.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return Scanned(spans, tokens(data, bounds), chars, bounds)


def _tags(scanned: Scanned) -> np.ndarray:
    """The tags that the exact spans give: begin and inside on the tokens of each value."""
    own = scanned.tokens
    tags = np.zeros(len(own.starts), dtype=np.int8)
    for i, spans in enumerate(scanned.spans):
        a, b = own.first[i], own.first[i + 1]
        base = scanned.chars[scanned.bounds[i]]
        if not spans:
            continue
        starts, ends = scanned.chars[own.starts[a:b]] - base, scanned.chars[own.ends[a:b]] - base
        for _, _, end, value in sorted(spans, key=lambda s: s[3]):
            covered = np.flatnonzero((starts >= value) & (ends <= end)) + a
            fresh = covered[tags[covered] == 0]
            if len(fresh):
                tags[fresh] = 2
                if fresh[0] == covered[0]:
                    tags[fresh[0]] = 1
    return tags


@dataclass
class Model:
    """Weights of features and of tag to tag, and of the tag that begins a text."""

    emit: np.ndarray
    move: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        out = self.emit[features[:, 0]].copy()
        for j in range(1, features.shape[1]):
            out += self.emit[features[:, j]]
        return out

    def decode(self, own: Tokens) -> np.ndarray:
        """The best tags of each text, by Viterbi.

        Where the score of "outside" is ahead by more than two moves can give back, the best
        path is outside; between such tokens the stretches are decoded by themselves.
        """
        n = len(own.starts)
        tags = np.zeros(n, dtype=np.int8)
        if not n:
            return tags
        scores = self.scores(own.features)
        gain = 2 * float(self.move.max() - self.move.min())
        open_ = scores[:, 0] - scores[:, 1:].max(axis=1) <= gain
        starts, ends, _ = runs(open_, own.first)
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            at_start = a == own.first[own.owner[a]]
            at_end = b == own.first[own.owner[a] + 1]
            tags[a:b] = self._path(scores[a:b], at_start, at_end)
        return tags

    def _path(self, scores: np.ndarray, at_start: bool, at_end: bool) -> list[int]:
        move, rows = self.move.tolist(), scores.tolist()
        best = rows[0] if at_start else [rows[0][t] + move[0][t] for t in range(N_TAGS)]
        back = []
        for row in rows[1:]:
            came = [max(range(N_TAGS), key=lambda s, t=t: best[s] + move[s][t]) for t in range(N_TAGS)]
            best = [best[came[t]] + move[came[t]][t] + row[t] for t in range(N_TAGS)]
            back.append(came)
        final = best if at_end else [best[t] + move[t][0] for t in range(N_TAGS)]
        path = [max(range(N_TAGS), key=final.__getitem__)]
        for came in reversed(back):
            path.append(came[path[-1]])
        return path[::-1]


def fit(features: np.ndarray, tags: np.ndarray, known: np.ndarray, rounds: int = ROUNDS, l2: float = 0.5) -> Model:
    """The weights of greatest penalised likelihood, by gradient steps over all windows at once.

    ``features`` is windows x length x features, ``tags`` windows x length, ``known`` which
    tokens exist. Missing tokens carry the padding feature and the tag "outside".
    """
    n, length, _ = features.shape
    emit, move = np.zeros((N_FEATURES, N_TAGS)), np.zeros((N_TAGS, N_TAGS))
    one_hot = np.eye(N_TAGS)[tags] * known[..., None]
    pair_known = known[:, :-1] & known[:, 1:]
    seen_pairs = np.zeros((N_TAGS, N_TAGS))
    np.add.at(seen_pairs, (tags[:, :-1][pair_known], tags[:, 1:][pair_known]), 1)
    grad_sum, move_sum = np.full_like(emit, 1e-8), np.full_like(move, 1e-8)
    flat_features = features.reshape(n * length, -1)
    for _ in range(rounds):
        score = emit[features].sum(axis=2)
        forward, backward = np.zeros((n, length, N_TAGS)), np.zeros((n, length, N_TAGS))
        forward[:, 0] = score[:, 0]
        for t in range(1, length):
            step = forward[:, t - 1, :, None] + move
            top = step.max(axis=1)
            forward[:, t] = score[:, t] + top + np.log(np.exp(step - top[:, None]).sum(axis=1))
        for t in range(length - 2, -1, -1):
            step = move + (score[:, t + 1] + backward[:, t + 1])[:, None, :]
            top = step.max(axis=2)
            backward[:, t] = top + np.log(np.exp(step - top[..., None]).sum(axis=2))
        whole = np.logaddexp.reduce(forward[:, -1], axis=1)[:, None, None]
        share = np.exp(forward + backward - whole) * known[..., None]
        pairs = np.exp(
            forward[:, :-1, :, None] + move + (score[:, 1:] + backward[:, 1:])[:, :, None, :] - whole[..., None]
        )
        move_step = seen_pairs - (pairs * pair_known[..., None, None]).sum(axis=(0, 1)) - l2 * move
        apart = (one_hot - share).reshape(n * length, N_TAGS)
        step = np.stack(
            [
                sum(
                    np.bincount(flat_features[:, j], weights=apart[:, t], minlength=N_FEATURES)
                    for j in range(flat_features.shape[1])
                )
                for t in range(N_TAGS)
            ],
            axis=1,
        ) - l2 * emit
        grad_sum += step**2
        move_sum += move_step**2
        emit += 0.5 * step / np.sqrt(grad_sum)
        move += 0.5 * move_step / np.sqrt(move_sum)
    return Model(emit, move)


#: What may stand between a name and a secret where the patterns see none.
JOINTS = (" ~ ", " -> ", " is ", " ", " | ", " #")
_BASE62 = DIGITS + LETTERS_LOWER.upper() + LETTERS_LOWER


def other_form(name: str, value: str, seed: int) -> tuple[str, str]:
    """What stands before a secret and the secret, in a form that no pattern knows.

    The name is left out in half of the forms and joined otherwise; the value's letters become
    capitals, are drawn anew from all letters and digits or from capitals behind a prefix, or
    the value is cut. Drawn by ``seed``, so a row gives the same forms each time.
    """
    draw = np.random.default_rng(seed)
    before = "" if draw.random() < 0.5 else name + JOINTS[draw.integers(len(JOINTS))]
    quote = ("", "", '"', "'")[draw.integers(4)]
    length = int(draw.integers(16, 41))
    kind = draw.integers(5)
    if kind == 0:
        value = value.upper() if value.lower() != value.upper() else value
    elif kind == 1:
        value = "".join(draw.choice(list(_BASE62), length))
    elif kind == 2:
        value = "".join(draw.choice(list(_BASE62[10:36]), 4)) + "".join(draw.choice(list(_BASE62[:36]), length - 4))
    elif kind == 3:
        value = "".join(draw.choice(list(DIGITS + "abcdef"), int(draw.integers(14, HEX_CHARS))))
    else:
        value = value[: max(12, len(value) // 2)]
    return before + quote, value


def _forms(text: str, span: tuple[str, int, int, int], seed: int) -> list[tuple[str, str, str]]:
    """Text before, secret, and text after it, of the other forms of a labelled span."""
    kind, start, end, value = span
    name = re.split(r"[^A-Za-z_]", text[start:value], maxsplit=1)[0] if kind == "assign" else ""
    left, right = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    out = []
    for i in range(FORMS_PER_SPAN):
        before, secret = other_form(name, text[value:end], seed + i)
        if any(c.isdigit() for c in secret):
            out.append((f"{left.rstrip()} {before}" if left else before, secret, right if right[:1] in " \n\"'.,;)" else f" {right}"))
    return out


def _drawn(places: np.ndarray, count: int, key: np.uint64) -> list[int]:
    """``count`` of the places, drawn by a hash of each, so that all parts of a text are seen."""
    if len(places) <= count:
        return places.tolist()
    rank = mix(places.astype(np.uint64) * np.uint64(2654435761) + key)
    return places[np.argsort(rank, kind="stable")[:count]].tolist()


def _window(own: Tokens, tags: np.ndarray, i: int, middle: int) -> tuple[list[int], list[int]]:
    """Features and tags of the tokens around one; -1 where the text has none."""
    a, b = int(own.first[i]), int(own.first[i + 1])
    at = np.arange(middle - REACH, middle + REACH + 1)
    inside = (at >= a) & (at < b)
    rows = np.full((len(at), N_PER_TOKEN), PADDING, dtype=np.int32)
    rows[inside] = own.features[at[inside]]
    keep = np.full(len(at), -1, dtype=np.int32)
    keep[inside] = tags[at[inside]]
    return rows.ravel().tolist(), keep.tolist()


def _form_windows(texts: list[str], scanned: Scanned) -> list[tuple[str, list[int], list[int]]]:
    """Windows around the other forms of labelled spans."""
    made, file = [], []
    for i, spans in enumerate(scanned.spans):
        for at in _drawn(np.arange(len(spans)), SPANS_PER_DOC, np.uint64(len(texts[i]))):
            seed = int(mix(np.array([spans[at][1], len(texts[i])], np.uint64)).sum() >> np.uint64(1))
            found = _forms(texts[i], spans[at], seed)
            made += found
            file += [int(scanned.tokens.file[i])] * len(found)
    if not made:
        return []
    data, bounds = flat(pa.array(["".join(parts) for parts in made], pa.string()))
    own = tokens(data, bounds, np.array(file, np.int32))
    tags = np.zeros(len(own.starts), np.int8)
    out = []
    for i, (before, secret, _) in enumerate(made):
        start = bounds[i] + len(before.encode())
        end = start + len(secret.encode())
        a, b = int(own.first[i]), int(own.first[i + 1])
        inside = np.flatnonzero((own.starts[a:b] >= start) & (own.ends[a:b] <= end)) + a
        if not len(inside):
            continue
        tags[inside] = 2
        tags[inside[0]] = 1
        out.append(("form", *_window(own, tags, i, int(inside[0]))))
    return out


def _training_windows(batches):
    """``kind, features, tags`` of windows around spans, their other forms, and other tokens."""
    for batch in batches_of_bytes(batches, "text", SCAN_BYTES):
        scanned = scan_texts(batch.column("text"))
        own, tags = scanned.tokens, _tags(scanned)
        digits = (own.features[:, 0] & 4) > 0 if len(tags) else np.zeros(0, bool)
        windows = _form_windows(batch.column("text").to_pylist(), scanned)
        for i in range(len(scanned.spans)):
            a, b = int(own.first[i]), int(own.first[i + 1])
            key = np.uint64(b - a)
            spans = a + np.flatnonzero(tags[a:b] == 1)
            others = a + np.flatnonzero(digits[a:b] & (tags[a:b] == 0))
            plain = a + np.flatnonzero(~digits[a:b] & (tags[a:b] == 0))
            drawn = [(k, m) for k, places, n in (
                ("span", spans, SPANS_PER_DOC), ("other", others, DIGITS_PER_DOC), ("other", plain, PLAIN_PER_DOC)
            ) for m in _drawn(places, n, key)]
            windows += [(kind, *_window(own, tags, i, middle)) for kind, middle in drawn]
        if windows:
            kinds, features, marks = zip(*windows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds), pa.array(features, pa.list_(pa.int32())), pa.array(marks, pa.list_(pa.int32()))],
                names=["kind", "features", "tags"],
            )


def train(docs: DataFrame, text_col: str = "text", rows: int = TRAIN_ROWS, windows: int = TRAIN_WINDOWS) -> Model | None:
    """A model whose labels are the exact spans of a bounded sample; None where it has none.

    About ``rows`` rows, drawn by a hash of the text, give windows, of which about ``windows``
    different ones, drawn by their hash, are gathered in the shares of SHARES. Labelled spans
    come as they are and in forms that the patterns do not know, so that shape and surroundings
    have to carry them; the other windows are around tokens that are no secret.
    """
    named = docs.select(text_or_empty(text_col).alias("text"))
    total = named.count()
    if total > rows:
        part = int(rows / total * (1 << 30))
        named = named.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < part)
    found = named.mapInArrow(tidied(_training_windows), "kind string, features array<int>, tags array<int>")
    # Copies of a text give the same windows, which count once.
    different = stored(found.dropDuplicates(["kind", "features"]), "secret-windows")
    counts = {r["kind"]: r["count"] for r in different.groupBy("kind").count().collect()}
    if not counts.get("span"):
        return None
    drawn = F.pmod(F.xxhash64("features"), F.lit(1 << 30))
    wanted = F.lit(False)
    for kind, share in SHARES.items():
        part = int(min(1.0, share * windows / max(1, counts.get(kind, 0))) * (1 << 30))
        wanted = wanted | ((F.col("kind") == kind) & (drawn < part))
    taken = stored(different.filter(wanted).orderBy(drawn), "secret-sample").limit(2 * windows).collect()
    width = 2 * REACH + 1
    features = np.array([r["features"] for r in taken], dtype=np.int32).reshape(-1, width, N_PER_TOKEN)
    tags = np.array([r["tags"] for r in taken], dtype=np.int64).reshape(-1, width)
    return fit(features, np.maximum(tags, 0), tags >= 0)


def _found(scanned: Scanned, model: Model | None) -> list[list[tuple[str, int, int]]]:
    """Exact spans and, outside of them, spans of the model, by start and kind."""
    out = [[s[:3] for s in spans] for spans in scanned.spans]
    if model is not None:
        own = scanned.tokens
        tags = model.decode(own)
        begins = np.flatnonzero((tags == 1) | ((tags == 2) & np.concatenate([[True], (tags[:-1] == 0) | (owner_changes(own))])))
        for at in begins.tolist():
            i, end = int(own.owner[at]), at + 1
            while end < own.first[i + 1] and tags[end] == 2:
                end += 1
            base = scanned.chars[scanned.bounds[i]]
            a = int(scanned.chars[own.starts[at]] - base)
            b = int(scanned.chars[own.ends[end - 1]] - base)
            if all(b <= s[1] or a >= s[2] for s in scanned.spans[i]):
                out[i].append(("crf", a, b))
    kinds = (*KINDS, "crf")
    return [sorted(s, key=lambda x: (x[1], kinds.index(x[0]), x[2])) for s in out]


def owner_changes(own: Tokens) -> np.ndarray:
    return own.owner[1:] != own.owner[:-1]


def find(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` of every row: kind, start and end in code points, by start and kind.

    Kinds are those of the exact patterns, and "crf" for what the model tags outside of them.
    A null text is empty; rows may repeat; an empty table gives an empty one.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text"))
    fields = [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]

    def run(batches):
        for batch in batches_of_bytes(batches, "text", SCAN_BYTES):
            found = _found(scan_texts(batch.column("text")), model)
            spans = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in own] for own in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(spans, pa.list_(pa.struct(fields)))], names=["doc_id", "spans"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tidied(run), f"doc_id {kind}, spans array<struct<kind: string, start: long, end: long>>")


def redact(docs: DataFrame, model: Model | None, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span replaced by ``mark``; overlapping spans by one. Nulls stay null."""
    def run(batches):
        for whole in batches:
            for batch in batches_of_bytes([whole], text_col, SCAN_BYTES):
                place = batch.schema.get_field_index(text_col)
                texts = batch.column(place)
                filled = texts.fill_null("")
                changed = []
                for text, spans in zip(texts.to_pylist(), _found(scan_texts(filled), model), strict=True):
                    parts, at = [], 0
                    for _, start, end in spans:
                        if start >= at:
                            parts += [text[at:start], mark]
                        at = max(at, end)
                    changed.append("".join(parts) + text[at:] if spans else text)
                columns = list(batch.columns)
                columns[place] = pa.array(changed, texts.type)
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(tidied(run), docs.schema)


def digests(found: DataFrame) -> DataFrame:
    """Counts and digests of the exact spans of ``find``, and all spans as text."""
    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "crf")
    return found.select(
        "doc_id", *map(count, KINDS), F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
