"""Plain versions of the operators' contracts, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def line_dedup(rows, least_chars=20, least_docs=3):
    """{id: (lines, dropped, kept text)} for rows of distinct ids."""
    holders = defaultdict(set)
    key = lambda line: lower(line.strip(SPACE))
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(i)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least_chars or len(holders[key(x)]) < least_docs or max(holders[key(x)]) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def shingles(text):
    w = WORD.findall(lower(text))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components(rows):
    """{id: (set size, smallest linked id)}."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def substring_dedup(rows, size=20):
    """{id: (words, removed, kept text)}."""
    first, words = {}, {i: WORD.findall(t or "") for i, t in rows}
    for i in sorted(words):
        for k in range(len(words[i]) - size + 1):
            first.setdefault(tuple(words[i][k : k + size]), (i, k))
    out = {}
    for i, w in words.items():
        gone = {k + j for k in range(len(w) - size + 1) if first[tuple(w[k : k + size])] != (i, k) for j in range(size)}
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def template(text):
    """(template token, value) pairs."""
    units = set("mm cm m km in inch inches ft foot feet kg g mg hour hours minute minutes day days dollars percent".split())
    text = re.sub(r"(?<=\d)[.,:/](?=\d)", "\u0005", text or "")
    tokens = [(m[0], m.start()) for m in re.finditer("[^\\W_\u0005](?:[^\\W_]|\u0005)*", text)]
    out, before = [], None
    for value, at in tokens:
        lead = text[max(0, at - 2) : at]
        if before and before[0][-1].isdigit() and at - before[1] - len(before[0]) <= 1 and value.lower() in units:
            out.append(("<unit>", value))
        elif value[0].isdigit():
            out.append(("<num>", value))
        elif re.fullmatch(r"[^\W\d_][a-zà-öø-ÿ].*", value) and value[0].isupper() and len(lead) == 2 and lead[1] == " " and (lead[0].isalnum() or lead[0] in ",;"):
            out.append(("<name>", value))
        else:
            out.append((value.lower(), value))
        before = (value, at)
    return out


def contaminated(rows, items, coverage=0.6):
    """{(id, item)}: some alignment agrees in enough tokens, with slots one to one."""
    asked = {k: template(t) for k, t in items}
    found = set()
    for i, t in rows:
        held = template(t)
        for k, q in asked.items():
            for shift in range(-len(q), len(held)):
                pairs = [(a, held[j + shift]) for j, a in enumerate(q) if 0 <= j + shift < len(held) and a[0] == held[j + shift][0]]
                slots = {(a[1].lower(), b[1].lower()) for a, b in pairs if a[0].startswith("<")}
                one = len(slots) == len({a for a, _ in slots}) == len({b for _, b in slots})
                if len(pairs) >= coverage * len(q) and one:
                    found.add((i, k))
    return found


def packed_well(pieces, capacity):
    """Checks slots of (sequence, offset, length) and returns the number of sequences."""
    by = defaultdict(list)
    for sequence, offset, length in pieces:
        by[sequence].append((offset, length))
    for slots in by.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def top_k(vectors, queries, k):
    out = {}
    for q in queries:
        scored = sorted(((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q))
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def counted(values):
    return Counter(values)
