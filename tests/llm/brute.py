"""Plain, slow versions of the operators, and texts that try their edges."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import xxhash

WORDS = "the of and erin onst thatly ingou hesh réeux ñasa chkeit atinth wherou ndion esthe anle".split()
AWKWARD = [
    None, "", " ", "\n\t \r", "x", "é", "one two", "a" * 3000, "ab " * 4000, "\n\n\n", "a\nb\n\na\nb",
    "!!! ??? ...", "word\x0bword\x0cword", "tab\tand no-break", "\x1c\x85  end", "中文 字符 测试",
]


def prose(words: int, seed: int) -> str:
    chance = random.Random(seed)
    return " ".join(chance.choice(WORDS) + chance.choice(["", "", "s", "ed", ",", "."]) for _ in range(words))


def texts(count: int = 30, seed: int = 1) -> list:
    chance = random.Random(seed)
    made = [prose(chance.randint(5, 300), seed * 1000 + i) for i in range(count)]
    return AWKWARD + made + made[:3] + [made[0] + " once more", prose(20_000, seed)]


def table(spark, rows, text="text"):
    """Documents with columns whose names operators use themselves."""
    extra = ", row string, spans int, counts int, id string, levels int"
    values = [(i, t, "en", f"s{(i or 0) % 3}", None if t is None else len(t), "r", 1, 2, "i", 3) for i, t in rows]
    return spark.createDataFrame(
        values, f"doc_id long, {text} string, lang string, source string, n_chars long{extra}"
    )


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def counts(text):
    text = text or ""
    words = split(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {
        k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)
    }
    lines = [x for x in text.split("\n") if split(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered),
    )


def fingerprint(text):
    words = split(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def connected(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def entropy(characters):
    n = len(characters)
    return math.log2(n) - sum(c * math.log2(c) for c in Counter(characters).values()) / n


def secrets(text, module):
    text, found = text or "", []
    assign = r"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    for m in re.finditer(assign, text):
        if len(m[1]) >= 12:
            found.append((m.start(), 0, m.end()))
    for rank, pattern, least in ((1, "AKIA[A-Z0-9]+", 18), (2, "[0-9a-f]+", 16)):
        found += [(m.start(), rank, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    for kind, (pattern, alphabet, least) in module.CLASSES.items():
        for m in re.finditer(pattern, text):
            plain = m[0].lower() if alphabet.islower() else m[0].replace("-", "+").replace("_", "/")
            held = any(a <= m.start() and m.end() <= b for a, _, b in found)
            if held or any(re.search(a, m[0]) for a in module.ALLOWED):
                continue
            if any(entropy(plain[i : i + 20]) >= least - 1e-9 for i in range(len(plain) - 19)):
                found.append((m.start(), module.KINDS.index(kind), m.end()))
    return sorted(found)


def masked(text, spans):
    out, at = "", 0
    for start, _, end in spans:
        if start >= at:
            out += text[at:start] + "[SECRET]"
        at = max(at, end)
    return out + text[at:]


def contained(text, templates, share=0.8):
    def shingles(t):
        words = re.findall(r"[^\W_]+", (t or "").lower())
        return [" ".join(words[i : i + 5]) for i in range(len(words) - 4)]

    own, found = shingles(text), {}
    for name, template in templates.items():
        wanted = list(dict.fromkeys(shingles(template)))
        common = [s for s in wanted if s in set(own)]
        if len(common) / len(wanted) >= share:
            found[name] = (len(common) / len(wanted), min(map(own.index, common)))
    return found


def overlaps(text, item):
    """Most agreeing words of any 20 aligned ones (of all, if the item has fewer), or None."""
    def words(t):
        return re.findall("[a-z0-9\u0080-\U0010ffff]+", (t or "").lower())

    own, wanted = words(text), words(item)
    if len(wanted) < 5:
        return None
    window, best = min(20, len(wanted)), 0
    for shift in range(-len(wanted), len(own) + 1):
        agree = [
            0 <= i + shift < len(own) and own[i + shift] == w for i, w in enumerate(wanted)
        ]
        best = max(best, max(sum(agree[i : i + window]) for i in range(len(wanted) - window + 1)))
    return best if best >= math.ceil(0.8 * window - 1e-9) else None


def copies(texts):
    """Least id linked to each by SimHashes within two bits, or a five-word Jaccard of 0.8."""
    prints, sets = {i: fingerprint(t) for i, t in texts.items()}, {}
    for i, t in texts.items():
        words = split(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()

    def linked(a, b):
        x, y = sets[a], sets[b]
        if x and 0.8 * max(len(x), len(y)) <= min(len(x), len(y)) and len(x & y) >= 0.8 * len(x | y) - 1e-9:
            return True
        return bin(prints[a] ^ prints[b]).count("1") <= 2

    return connected(sorted(texts), linked)
