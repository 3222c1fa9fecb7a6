"""Plain Python versions of the operators' results."""

import hashlib
import math
import re
import string
import zlib
from collections import Counter

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(doc_id, folds):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % folds


def quality(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    count, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if count[x] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(w)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def base_scores(docs):
    """{position: (n_tokens, n_known, train_tokens, base_score)}."""
    tokens = [WORD.findall((t or "").translate(LOWER)) + ["\n"] for _, t in docs]
    count = Counter(x for (i, _), ts in zip(docs, tokens, strict=True) if fold(i, 5) != 1 for x in ts)
    total, kinds = sum(count.values()), len(count)
    return [(len(ts), sum(count[x] > 0 for x in ts), total,
             sum(math.log10((count[x] + 0.5) / (total + 0.5 * (kinds + 1))) for x in ts)) for ts in tokens]


def contamination(text, items):
    """(n_words, n_hit, sorted item ids) for items (id, text)."""
    w = ALNUM.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for item, t in items:
        b = ALNUM.findall((t or "").translate(LOWER))
        n = min(10, len(b))
        for k in range(len(b) - n + 1 if n else 0):
            for s in range(len(w) - n + 1):
                if w[s:s + n] == b[k:k + n]:
                    hit |= set(range(s, s + n))
                    if item is not None:
                        found.add(str(item))
    return len(w), len(hit), sorted(found)


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def components(texts):
    """Smallest position reachable over links of 85 percent, by all pairs."""
    sets, parent = [shingle_set(t) for t in texts], list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [root(i) for i in range(len(texts))], [len(s) for s in sets]


def repeats(rows, length=50):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of (doc_id, text)."""
    key = lambda d: (d is None, d or 0)
    least, out = {}, []
    for d, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            s = b[p:p + length]
            least[s] = min(least.get(s, key(d)), key(d))
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if least[b[p:p + length]] < key(d):
                gone[p:p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def damage(rows):
    out = []
    for c, t, r, x in rows:
        sp = lambda v: " " if v is None else v
        k = zlib.crc32(f"{sp(c)}:{sp(t)}".encode()) % 20
        r, x = sp(r), sp(x)
        x = "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x
        out += [] if k == 0 else [(c, t, "user" if k == 4 else r, x)] * (2 if k == 3 else 1)
    return out


def repair(faults, roles):
    """Least (cost, audit) by trying every edit from every state: what must
    come next is told by the last initial."""
    after = {"": ["s", "u"], "s": ["u"], "u": ["a"], "a": ["u"]}
    memo = {}

    def best(i, last, inserts):
        key = i, last, inserts
        if key not in memo:
            got = [(0, "")] if i == len(roles) and last in ("", "a") else []
            need = "a" if last == "u" else "u"
            if inserts < 3:
                c, s = best(i, need, inserts + 1)
                got.append((c + 2, "I" + s))
            if i < len(roles):
                c, s = best(i + 1, last, 0)
                got.append((c + 3, "D" + s))
                if faults[i] not in ("blank", "duplicate"):
                    more = faults[i] == "truncated"
                    if roles[i][:1] in after[last] and roles[i]:
                        c, s = best(i + 1, roles[i][0], 0)
                        got.append((c + more, "K" + s))
                    c, s = best(i + 1, need, 0)
                    got.append((c + 2 + more, "R" + s))
            memo[key] = min(got) if got else (10**9, "")
        return memo[key]
    for i in reversed(range(len(roles))):  # from the end, so that the recursion stays flat
        for last in after:
            best(i, last, 0)
    return best(0, "", 0)


def conversation(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)
    of one conversation's damaged rows in order."""
    seen, faults = set(), []
    for _, _, r, x in rows:
        last = WORD.findall(x)
        faults.append("blank" if not last else "duplicate" if (r, x) in seen else "truncated" if last[-1][-1] not in ".!?" else "")
        seen.add((r, x))
    roles = [r for _, _, r, _ in rows]
    turns = [t for _, t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:], strict=False))
    cost, audit = repair(faults, roles)
    lines, i, last = [], 0, ""
    for e in audit:
        need = "assistant" if last == "u" else "user"
        if e == "I":
            lines.append(f"{need}:")
            last = need[0]
            continue
        role, text = roles[i], rows[i][3]
        i += 1
        if e != "D":
            role = need if e == "R" else role
            lines.append(f"{role}:{text}")
            last = role[0]
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest


def middle(doc_id, text):
    t = text or ""
    n = len(t)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    u = [int(h[8 * k:8 * k + 8], 16) for k in range(4)]
    p, q = sorted((u[0] % (n + 1), u[1] % (n + 1)))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    if not n or any(s in t for s in ("<P>", "<S>", "<M>")) or u[2] % 100 >= 90:
        return n, "plain", None, None, sha(t), sha(t)
    if u[3] % 100 < 20:
        return n, "spm", p, q - p, sha(f"<S>{t[q:]}<P>{t[:p]}<M>{t[p:q]}"), sha(t)
    return n, "psm", p, q - p, sha(f"<P>{t[:p]}<S>{t[q:]}<M>{t[p:q]}"), sha(t)
