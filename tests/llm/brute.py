"""Plain versions of the contracts, one text or one pair at a time."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            duplicates += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), duplicates, len(covered), failed)


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)])


def component_ids(docs, percent=85):
    """{doc_id: (set size, component)} by comparing every pair of documents."""
    sets = {d: shingles(t) for d, t in docs}
    label = {d: d for d in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    order = sorted(sets)
    for i, a in enumerate(order):
        for b in order[i + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


def contamination(docs, items, size=10):
    """{doc_id: (n_words, n_hit, sorted items)}"""
    def words(text):
        return PLAIN_WORD.findall((text or "").translate(LOWER))
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = {}
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for i in range(len(w)):
            for n in lengths:
                key = tuple(w[i:i + n])
                if len(key) == n and key in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[key]
        out[doc] = (len(w), len(hit), sorted(found))
    return out


def base_secrets(text):
    text, found = text or "", []
    key = "".join
    either = lambda w: key(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    names = "|".join([*map(either, ("password", "passwd", "secret", "token")), either("api") + "_?" + either("key")])
    for m in re.finditer(rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(2)) >= 8:
            found.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for number, kind, pattern, least in ((1, "access", r"AKIA[A-Z0-9]+", 16), (2, "hex", r"[0-9a-f]+", 32)):
        for m in re.finditer(pattern, text):
            if len(m.group()) >= least:
                found.append((m.start(), number, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(found)]


def url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return host.translate(LOWER), path


def url_rule(host, path, rules):
    fits = [(h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda f: len(f[0])) if fits else None


def glob_fits(glob, text):
    pattern = "".join(".*" if part == "**" else "[^/?]*" if part == "*" else re.escape(part) for part in re.split(r"(\*\*|\*)", glob))
    return re.fullmatch(pattern, text, re.S) is not None


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc(text):
    return zlib.crc32((text or "").encode())


def damage(rows):
    """{conv_id: [(turn, role, text)]} after the damage, by turn, nulls first."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if code == 1 else re.sub(r"[.!?]", "", text) if code == 2 else text
        kept += [(turn, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest())
    return {conv: sorted(kept, key=order) for conv, kept in out.items()}


def repair(rows):
    """The report on one conversation: edits by a left-to-right search over (role so far), one row at a time."""
    seen, faults, counts = set(), [], Counter()
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
        counts[fault] += 1
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}

    def with_insertions(states):
        done = dict(states)
        for _ in range(3):
            for state, (cost, audit, lines) in list(done.items()):
                for r in "ua":
                    if r in follows[state]:
                        way = (cost + 3, audit + "I", lines + [({"u": "user", "a": "assistant"}[r], "")])
                        if r not in done or way[:2] < done[r][:2]:
                            done[r] = way
        return done

    states = with_insertions({"": (0, "", [])})
    for (_, role, text), fault in zip(rows, faults):
        step, late = {}, 3 * (fault == "truncated")
        for state, (cost, audit, lines) in states.items():
            ways = [(state, (cost + 4, audit + "D", lines))]
            if fault not in ("blank", "duplicate"):
                if role[:1] and role[:1] in follows[state]:
                    ways.append((role[0], (cost + late, audit + "K", lines + [(role, text)])))
                ways += [(r, (cost + 3 + late, audit + "R", lines + [({"u": "user", "a": "assistant"}[r], text)])) for r in "ua" if r in follows[state]]
            for to, way in ways:
                if to not in step or way[:2] < step[to][:2]:
                    step[to] = way
        states = with_insertions(step)
    cost, audit, lines = min((states[s] for s in ("", "a") if s in states), key=lambda w: w[:2])
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
            sha("\n".join(f"{r}:{t}" for r, t in lines)), len(rows))


def cheapest_edits(kinds):
    """(cost, audit) over all edits of a few rows: kinds as 'u', 'a!', 'D1'; at most two insertions in a place."""
    from itertools import product

    best = None
    options = [["D"] if k[0] == "D" else ["D", "K", "Ru", "Ra"] for k in kinds]
    inserted = ["", "u", "a", "ua", "au"]
    for edits in product(*options):
        for added in product(inserted, repeat=len(kinds) + 1):
            cost, audit, said = 0, "", ""
            for i in range(len(kinds) + 1):
                cost, audit, said = cost + 3 * len(added[i]), audit + "I" * len(added[i]), said + added[i]
                if i < len(kinds):
                    e, late = edits[i], 3 * kinds[i].endswith("!")
                    cost += 4 if e == "D" else late if e == "K" else 3 + late
                    audit, said = audit + e[0], said + ("" if e == "D" else kinds[i][0] if e == "K" else e[1])
            if re.fullmatch("(s?(ua)+)?", said) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def page_report(pages, least=0):
    """[(page_id, payload_bytes, payload_digest, record_type, refers_to)]"""
    import base64

    raws = [(page, (html or "").encode()) for page, html in pages]
    first = {}
    for page, raw in raws:
        if page is not None and len(raw) >= least:
            first[raw] = min(page, first.get(raw, page))
    out = []
    for page, raw in raws:
        to = first.get(raw)
        revisit = to is not None and page != to
        out.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


def ranking(docs, items, top=20):
    """[(item_id, rank, doc_id, score)]"""
    import math

    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    counted = [(doc, Counter(terms(text))) for doc, text in docs]
    counted = [(doc, c) for doc, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in counted:
            m = 100 - 25 + 25 * sum(c.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored, key=lambda s: s[:3])[:top], 1)]
    return sorted(out, key=str)


def longest_match(words, texts, size):
    """(n_hit, items, (words, item, start)) of a document's words: islands of window hits on a diagonal."""
    hits, covered, items = set(), set(), set()
    for ids, text in texts:
        n = min(size, len(text))
        for s in range(len(text) - n + 1):
            for p in range(len(words) - n + 1):
                if words[p:p + n] == text[s:s + n]:
                    hits.add((ids[0], p - s, p, n))
                    covered |= set(range(p, p + n))
                    items |= set(ids)
    best = None
    for item, diagonal, p, n in hits:
        if (item, diagonal, p - 1, n) not in hits:
            k = 1
            while (item, diagonal, p + k, n) in hits:
                k += 1
            key = (-(k - 1 + n), item, diagonal, p)
            best = key if best is None or key < best else best
    return len(covered), sorted(items), (-best[0], best[1], best[3]) if best else (0, None, None)
