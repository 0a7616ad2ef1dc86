"""What the operators compute, in plain Python over small lists."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spaced_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, k=5):
    words = spaced_words((text or "").translate(LOWER))
    if len(words) < k:
        return {" ".join(words)} if words else set()
    return {" ".join(words[i : i + k]) for i in range(len(words) - k + 1)}


def components(rows, percent=80):
    """Of (id, text) rows: id to (set size, smallest id in reach), and all links."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    links = set()
    for x, (a, one) in enumerate(sets):
        for b, two in sets[x + 1 :]:
            if one and two and a != b and 100 * len(one & two) >= percent * len(one | two):
                links.add((min(a, b), max(a, b)))
                one_top, two_top = sorted((top(a), top(b)))
                root[two_top] = one_top
    return {i: (len(s), top(i)) for i, s in sets}, links


def quality(text):
    words = spaced_words(text)
    lines = [line for line in (text or "").split("\n") if spaced_words(line)]
    found = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if found[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": len(words) < 50 or 100 * len(covered) > 50 * len(words),
    }


def phrase_places(text, phrases):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = sorted(
        (i, label)
        for label, phrase in phrases
        for n in [len(phrase.split())]
        for i in range(len(words) - n + 1)
        if words[i : i + n] == phrase.split()
    )
    return len(words), places


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def common_in_order(one, two):
    """The length of the longest common subsequence."""
    row = [0] * (len(two) + 1)
    for a in one:
        row = list(itertools.accumulate(
            ((row[j] + 1 if a == b else row[j + 1]) for j, b in enumerate(two)), max, initial=0
        ))
    return row[-1]


def notice_spans(text, templates, slack=4, gap=8, share=0.7, short=12):
    """``label, start, end, coverage`` of notices: every pair of cells of the word matrix is looked at."""
    words, found = plain_words(text), []
    for label, template in templates:
        own = plain_words(template)
        cells = [
            (i, j) for i in range(len(words) - 1) for j in range(len(own) - 1)
            if words[i : i + 2] == own[j : j + 2]
        ]
        best = {}
        for i, j in cells:
            options = [(4, 2, i)]
            for (a, b), (count, agreeing, start) in best.items():
                left, skipped = i - a - 2, j - b - 2
                if (a, b) == (i - 1, j - 1):
                    options.append((count + 2, agreeing + 1, start))
                elif 0 <= left <= gap and 0 <= skipped <= gap and abs(left - skipped) <= slack:
                    options.append((count + 4 - left - skipped, agreeing + 2, start))
            best[i, j] = max(options)
        least = len(own) if len(own) <= short else share * len(own)
        ends = sorted((-c, start, i + 2, n) for (i, _), (c, n, start) in best.items())
        taken = []
        for _, start, end, n in ends:
            if n >= least and n >= share * (end - start) and all(end <= s or start >= e for s, e in taken):
                taken.append((start, end))
                found.append((label, start, end, n / len(own)))
    spans = set(found)
    return sorted(
        (x for x in spans if not any(
            y != x and y[0] == x[0] and y[1] <= x[1] and x[2] <= y[2] and (y[1:3] != x[1:3] or y[3] > x[3]) for y in spans
        )),
        key=lambda x: (x[1], -x[2], -x[3], x[0]),
    )


def exact_secrets(text):
    text = text or ""
    assign = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [("assign", *m.span()) for m in re.finditer(assign, text, re.ASCII) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def without_recurring_lines(rows, leading=4, min_tokens=4, min_template=8, percent=75):
    """Of (id, text) rows with distinct ids: id to the text that stays."""
    def tokens(line):
        masked = re.sub(r"[^ \t\x0B\f\r\n]*[0-9][^ \t\x0B\f\r\n]*", "<*>", line)
        return tuple(t for t in re.split(r"[ \t\x0B\f\r]+", masked) if t)

    owners, leaves = defaultdict(set), defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            t = tokens(line)
            if len(t) >= min_tokens:
                owners[t].add(i)
                leaves[len(t), t[:leading]].add(t)
    template = {t: t for t in owners}
    for leaf, lines in leaves.items():
        if len(lines) < 2 or leaf[0] < min_template:
            continue
        votes = Counter((place, token) for t in lines for place, token in enumerate(t))
        for t in lines:
            constant = sum(2 * votes[place, token] > len(lines) for place, token in enumerate(t))
            if 100 * constant >= percent * len(t):
                template[t] = leaf
    by_template = defaultdict(set)
    for t, ids in owners.items():
        by_template[template[t]] |= ids
    out = {}
    for i, text in rows:
        keep = [
            line for line in (text or "").split("\n")
            if tokens(line) not in template or i == min(by_template[template[tokens(line)]])
        ]
        out[i] = None if text is None else "\n".join(keep)
    return out


def equal_texts(rows):
    """Of (id, text) rows: (id, id that stays, group size, stays, digest), sorted as strings."""
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(i)
    out = []
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i or 0))
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, ids[0], len(ids), place == 0, digest) for place, i in enumerate(ids)]
    return sorted(out, key=repr)


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def ranked(rows, items, top=10):
    """``ranked_any``, sorted."""
    return sorted(ranked_any(rows, items, top))


def ranked_any(rows, items, top=10):
    """Of (id, text) rows and items: (item, rank, id, score), scores computed for every document."""
    found = [(i, Counter(terms(t))) for i, t in rows]
    found = [(i, c) for i, c in found if c]
    n_docs, n_terms = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(terms(text))
    out = []
    for item, own in asked.items():
        hits = []
        for i, c in found:
            m = 10 + 90 * sum(c.values()) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in own if t in c
            )
            if score > 0:
                hits.append((-score, i is None, i or 0, i))
        out += [(item, rank + 1, h[3], -h[0]) for rank, h in enumerate(sorted(hits)[:top])]
    return out


def damage(rows):
    """Of (conversation, turn, role, text) rows: those that stay, with faults by a checksum."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        fate = zlib.crc32(":".join(" " if v is None else str(v) for v in (conv, turn)).encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return out


def _ways(role, fault, state):
    """State after, cost, letter and role of what may be done with one row."""
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
    yield state, 2, "D", None
    if fault in ("blank", "duplicate"):
        return
    extra = 5 if fault == "truncated" else 0
    if role[:1] and role[:1] in follows:
        yield role[0], extra, "K", role
    for name in ("user", "assistant"):
        if name[0] in follows:
            yield name[0], extra + 1, "R", name


def faults(rows):
    """The first fault of each of (role, text) rows, or None."""
    seen, out = set(), []
    for role, text in rows:
        visible = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append(
            "blank" if not visible else "duplicate" if (role, text) in seen
            else "truncated" if visible[-1] not in ".!?" else None
        )
        seen.add((role, text))
    return out


def all_edits(rows):
    """Of (role, fault) rows: cost and audit of every way to a legal order, with up to two inserts in a row."""
    def go(at, state, n_inserts):
        if at == len(rows) and state in ("", "a"):
            yield 0, ""
        if n_inserts < 2:
            role = "a" if state == "u" else "u"
            for cost, audit in go(at, role, n_inserts + 1):
                yield cost + 5, "I" + audit
        if at < len(rows):
            for after, cost, letter, _ in _ways(*rows[at], state):
                for more, audit in go(at + 1, after, 0):
                    yield cost + more, letter + audit

    return go(0, "", 0)


def repair(rows):
    """Of one conversation's (turn, role, text) rows, after damage: what the query returns."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    fault = faults([(role, text) for _, role, text in rows])
    turns = {t for t, _, _ in rows if t is not None}
    pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(rows)]
    best = {"": (0, "", ())}

    def with_inserts(found):
        for _ in range(2):
            for state, (cost, audit, out) in list(found.items()):
                name = "assistant" if state == "u" else "user"
                way = (cost + 5, audit + "I", (*out, f"{name}:"))
                if name[0] not in found or way < found[name[0]]:
                    found[name[0]] = way
        return found

    for (_, role, text), own in zip(rows, fault, strict=True):
        after = {}
        for state, (cost, audit, out) in with_inserts(best).items():
            for to, extra, letter, name in _ways(role, own, state):
                way = (cost + extra, audit + letter, out if name is None else (*out, f"{name}:{text}"))
                if to not in after or way < after[to]:
                    after[to] = way
        best = after
    cost, audit, out = min(way for state, way in with_inserts(best).items() if state in ("", "a"))
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(fault.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
        hashlib.sha256("\n".join(out).encode()).hexdigest(),
    )
