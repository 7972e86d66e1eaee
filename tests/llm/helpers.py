"""Small document tables, and plain versions of what the operators compute."""

import hashlib
import random
import re
from collections import defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, spans string, block string, label int"


def docs(spark, rows):
    """rows: (doc_id, text[, lang[, source]]); further columns have names that operators use inside."""
    full = [(*r, *("en", "s")[len(r) - 2 :], len(r[1] or ""), 7, "x", "y", 3) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def awkward(seed=0):
    """Copies, ties, shared passages, odd white space, empty and long texts, NULLs."""
    rng = random.Random(seed)
    passage = prose(rng, 70, 10**6)
    whole = prose(rng, 120, 10**6)
    rows = [(1, whole), (2, whole), (9, whole), (9, whole), (3, None), (4, ""), (5, " \n\t "), (None, whole), (None, None)]
    rows += [(10 + i, prose(rng, rng.randrange(3, 40)) + " " + passage + "\n" + prose(rng, 30)) for i in range(6)]
    rows += [(30, passage.replace(" ", "  \n")), (31, "ü" * 49), (32, "ü" * 25), (33, "ü" * 60), (34, "a " * 300)]
    rows += [(40, whole + " tail " + whole), (41, prose(rng, 5000, 10**6) + " " + whole), (42, "x" * 60_000)]
    return rows


def digest(data):
    return hashlib.sha256(data).hexdigest()


def without_repeats(rows, width, split):
    """For each row, its units and which of them go."""
    first = {}
    order = lambda d: 2**63 - 1 if d is None else d
    for d, t in rows:
        u = split((t or "").encode())
        for i in range(len(u) - width + 1):
            key = tuple(u[i : i + width])
            first[key] = min(first.get(key, 2**63), order(d))
    out = []
    for d, t in rows:
        u = split((t or "").encode())
        gone = [False] * len(u)
        for i in range(len(u) - width + 1):
            if first[tuple(u[i : i + width])] < order(d):
                gone[i : i + width] = [True] * width
        out.append((d, u, gone))
    return out


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    out = []
    for k, (name, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            number = re.sub("[^0-9]", "", m.group())
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 12 <= len(number) <= 19 and luhn(number),
                "phone": lambda: 9 <= len(number) <= 15,
            }[name]()
            if good:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen = defaultdict(list)
    for i in range(len(words) - 2):
        seen[tuple(words[i : i + 3])].append(i)
    again = {j for v in seen.values() if len(v) > 1 for i in v for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(again)


class Groups(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def union(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)
