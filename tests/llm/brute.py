"""Plain versions of the operators, small and slow, to hold results against."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import defaultdict


def components(rows, words, num, den):
    """``(doc_id, set size, smallest reachable id)`` of (doc_id, text) rows with unique ids."""
    sets = {}
    for i, text in rows:
        found = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        whole = {tuple(found)} if found else set()
        sets[i] = whole if len(found) < words else {tuple(found[k : k + words]) for k in range(len(found) - words + 1)}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for i, found in sets.items():
        for x in found:
            where[x].append(i)
    for i, found in sets.items():
        common = defaultdict(int)
        for x in found:
            for j in where[x]:
                if j < i:
                    common[j] += 1
        for j, n in common.items():
            if den * n >= num * (len(found) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return sorted((i, len(s), find(i)) for i, s in sets.items())


def without_repeats(rows, length=100):
    """``(doc_id, n_bytes, n_removed, n_spans, sha256)`` of (doc_id, text) rows with unique ids."""
    seen, out = set(), []
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            part = data[s : s + length]
            if part in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(part)
        spans = sum(1 for j in range(len(data)) if gone[j] and (j == 0 or not gone[j - 1]))
        left = bytes(x for x, g in zip(data, gone) if not g)
        out.append((i, len(data), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return out


_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def secrets(text, candidate, allowed, thresholds, other):
    """All spans ``(start, kind, end)``; windows are counted anew at every place."""
    base = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m.group(1)) >= 12]
    base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 16]
    found = list(base)
    for m in re.finditer(candidate, text):
        hit = m.group()
        if re.search(allowed, hit):
            continue
        limit = next((v for p, v in thresholds.items() if re.search(p, hit)), other)
        high = []
        for i in range(len(hit) - 19):
            window = hit[i : i + 20]
            if -sum(window.count(c) / 20 * math.log2(window.count(c) / 20) for c in set(window)) >= limit - 1e-9:
                high.append(i)
        if high:
            start, end = m.start() + high[0], m.start() + high[-1] + 20
            if not any(b[0] <= start and end <= b[2] for b in base):
                found.append((start, 3, end))
    return sorted(found)


def redacted(text, spans, mark):
    merged = []
    for start, _, end in spans:
        if merged and merged[-1][1] > start:
            merged[-1][1] = max(end, merged[-1][1])
        else:
            merged.append([start, end])
    out, at = "", 0
    for start, end in merged:
        out, at = out + text[at:start] + mark, end
    return out + text[at:]


def raked(cells, margins, targets, rounds):
    """Weights by cell after the same rounds of proportional fitting."""
    total = sum(cells.values())
    weights = dict(cells)
    for _ in range(rounds):
        for place, margin in enumerate(margins):
            there = {c[place] for c, w in cells.items() if w > 0}
            scale = sum(s for v, s in targets[margin].items() if v in there)
            sums = defaultdict(float)
            for c, w in weights.items():
                sums[c[place]] += w
            for c in weights:
                goal = targets[margin].get(c[place], 0) / scale * total
                weights[c] *= goal / sums[c[place]] if sums[c[place]] else 0
    return weights


def edited_texts(seed, families=40, vocabulary=2500):
    """Families of texts with a few edits each, unrelated texts that share a line, and odd ones."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    rows = []
    for _ in range(families):
        base = rng.choices(words, k=rng.choice([3, 5, 9, 10, 11, 19, 20, 30, 60, 150, 400]))
        for _ in range(rng.randint(1, 20)):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                place, kind = rng.randrange(len(text)), rng.random()
                if kind < 0.4:
                    text[place] = rng.choice(words)
                elif kind < 0.7 and len(text) > 1:
                    del text[place]
                else:
                    text.insert(place, rng.choice(words))
            rows.append((len(rows) * 3 + 1, " ".join(text)))
    line = rng.choices(words, k=12)
    for _ in range(200):
        rows.append((len(rows) * 3 + 1, " ".join(rng.choices(words, k=rng.randint(0, 30)) + line + rng.choices(words, k=rng.randint(0, 30)))))
    odd = ["", None, " \t", "a", "A", "a b", "b a"]
    return rows + [(1_000_000 + i, t) for i, t in enumerate(odd)]


def linked_families(families=6, size=3604):
    """Long texts in pairs of groups, each joined by one pair alone: eight texts a family.

    The pair is barely similar enough. The other texts of a group share one more edit, so they and not the
    pair are the hubs of the keys that the pair meets on.
    """
    rows = []
    for family in range(families):
        rng = random.Random(family)
        base = [f"f{family}w{i}" for i in range(size)]
        places = rng.sample(range(10, size - 10, 20), size // 45 + 6)
        edits = size // 45

        def edited(chosen):
            text = list(base)
            for place in chosen:
                text[place] = f"e{place}"
            return " ".join(text)

        far, (one, other, *more) = places[:edits], places[edits:]
        texts = [edited([]), edited([one]), *(edited([one, x]) for x in more[:2])]
        texts += [edited(far), edited([*far, other]), *(edited([*far, other, x]) for x in more[2:])]
        rng.shuffle(texts)
        rows += [(len(rows) + i, t) for i, t in enumerate(texts)]
    return rows


def repeating_texts(seed, n=300):
    """Texts put together from passages, runs of one letter, common lines and words of several bytes."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(2000)] + ["é", "日本", "🙂"]
    passages = [" ".join(rng.choices(words, k=rng.randint(10, 80))) for _ in range(30)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 6)):
            x = rng.random()
            if x < 0.5:
                parts.append(" ".join(rng.choices(words, k=rng.randint(1, 40))))
            elif x < 0.8:
                parts.append(rng.choice(passages)[rng.randint(0, 50) :])
            elif x < 0.85:
                parts.append("a" * rng.randint(1, 400))
            elif x < 0.9:
                parts.append("ab c" * rng.randint(1, 100))
            else:
                parts.append("THE COMMON LINE " * 6)
        rows.append((i * 2, " ".join(parts)))
    return rows + [(5000, ""), (5001, None), (5002, "x" * 99), (5003, "x" * 100), (5004, "x" * 101)]
