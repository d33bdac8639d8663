"""Plain Python versions of what the operators compute."""

import hashlib
import math
import re

ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"
    r"[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return re.sub(r"[^0-9]", "", text)


def luhn(text):
    total = 0
    for i, c in enumerate(reversed(digits(text))):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def secret_spans(text):
    text = text or ""
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    return out + [("hex", *m.span()) for m in HEX.finditer(text) if len(m[0]) >= 32]


def pii_spans(text):
    text = text or ""
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 14 <= len(digits(m[0])) <= 19 and luhn(m[0])]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]


def joined(spans, kinds):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], kinds.index(x[0]), x[2])))


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def entropy_runs(text, alphabet, window, bits, fold):
    """Stretches of windows whose entropy is at least ``bits``, every window counted anew."""
    text = text.lower() if fold else text
    runs = []
    for at in range(len(text) - window + 1):
        part = text[at : at + window]
        if any(c not in alphabet for c in part):
            continue
        n = sum(c in "0123456789" for c in part)
        if n in (0, window):
            continue
        shares = [part.count(c) / window for c in set(part)]
        if -sum(p * math.log2(p) for p in shares) < bits:
            continue
        if runs and runs[-1][1] >= at:
            runs[-1][1] = at + window
        else:
            runs.append([at, at + window])
    return runs


def words(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in found]


def shingles(text):
    w = words(text)
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def key_of_line(line):
    line = line.strip(" \t\n\x0b\x0c\r")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)


def deduped_lines(rows, min_chars=40, min_docs=5):
    """(n_lines, n_dropped, text) of every row of (doc_id, text)."""
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(key_of_line(line)) >= min_chars:
                holders.setdefault(key_of_line(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if doc is None or len(holders.get(key_of_line(x), ())) < min_docs or max(holders[key_of_line(x)]) == doc
        ]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def near_components(rows, percent=85):
    """doc_id -> smallest doc_id reachable over links; every pair is looked at."""
    parent = {doc: doc for doc, _ in rows if doc is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(doc, shingles(text)) for doc, text in rows if doc is not None]
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {doc: root(doc) for doc in parent}


def contained(docs, items, percent=80):
    """{(item_id, doc_id): (n_item, n_common)}"""
    held = [(doc, shingles(text)) for doc, text in docs if doc is not None]
    out = {}
    for item, text in items:
        own = shingles(text)
        for doc, x in held:
            if own and 100 * len(own & x) >= percent * len(own):
                out[item, doc] = (len(own), len(own & x))
    return out


def targets(sizes, weights=(1, 2, 3), most=3):
    """source -> target, the excess over caps shared out again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, rest, out = set(names), float(sum(sizes.values())), {}
    while left:
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = {s for s in left if share[s] >= most * sizes[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = float(most * sizes[s])
            rest -= out[s]
        left -= over
    return out
