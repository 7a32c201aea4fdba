"""Plain versions of the operators, one document at a time."""

import math
import re
from collections import Counter

PLAIN = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def base_counts(text):
    text = text or ""
    w = PLAIN.findall(text)
    c = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    hit = {k + j for k in range(len(w) - 2) if c[tuple(w[k : k + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if PLAIN.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), failed


def decontaminate(docs, items, size=10):
    """{(id, text): (n_words, n_hit, items)}"""
    windows = {}
    for item, text in items:
        w = LETTERS.findall(lower(text))
        n = min(size, len(w))
        for p in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[p : p + n]), set()).add(str(item))
    out = {}
    for i, text in docs:
        w = LETTERS.findall(lower(text))
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for p in range(len(w) - n + 1):
                if (k := tuple(w[p : p + n])) in windows:
                    hit |= set(range(p, p + n))
                    found |= windows[k]
        out[i, text] = (len(w), len(hit), sorted(found))
    return out


def quality(docs, trusted, prior=5):
    """([target and raw n-grams], threshold, [(id, score, kept)]) of documents, by n-grams that are not hashed."""
    grams = []
    for _, text in docs:
        w = PLAIN.findall(text or "")
        grams.append(Counter([*w, *zip(w, w[1:], strict=False)]))
    raw = sum(grams, Counter())
    target = sum((g for (i, _), g in zip(docs, grams, strict=True) if i in trusted), Counter())
    share = target.total() / raw.total()

    def score(own, of_target):
        terms = (n * math.log((target[g] - n * of_target + prior * share) / ((raw[g] - n + prior) * share)) for g, n in own.items())
        return sum(terms) / max(own.total(), 1)

    failed = [base_counts(text)[-1] for _, text in docs]
    bins = sorted(math.floor(score(g, True) / 0.001) for (i, _), g, f in zip(docs, grams, failed, strict=True) if i in trusted and not f)
    low, middle = (bins[math.ceil(q * len(bins)) - 1] for q in (0.01, 0.5))
    threshold = (2 * low - middle) * 0.001
    plain = [score(g, False) for g in grams]
    return [target.total(), raw.total()], threshold, [(i, s, not f and s >= threshold) for (i, _), s, f in zip(docs, plain, failed, strict=True)]


def line_dedup(docs, size=2):
    """[(id, n_lines, n_removed, kept)] of documents in order."""
    seen, out = set(), []
    for i, text in docs:
        lines = (text or "").split("\n")
        solid = [k for k, x in enumerate(lines) if PLAIN.search(x)]
        gone = set()
        for p in range(len(solid) - size + 1):
            run = solid[p : p + size]
            key = tuple(lines[k] for k in run)
            if key in seen:
                gone |= set(run)
            seen.add(key)
        out.append((i, len(lines), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone)))
    return out


def substring_dedup(docs, size=20):
    """[(id, n_words, n_removed, kept)] of documents in order."""
    seen, out = set(), []
    for i, text in docs:
        w = PLAIN.findall(text or "")
        gone = set()
        for p in range(len(w) - size + 1):
            key = tuple(w[p : p + size])
            if key in seen:
                gone |= set(range(p, p + size))
            seen.add(key)
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def shingles(text, n):
    w = PLAIN.findall(lower(text))
    return frozenset([tuple(w[k : k + n]) for k in range(len(w) - n + 1)] or ([tuple(w)] if w else []))


def jaccard(docs, n, percent):
    """{id: (n_shingles, component)} for distinct ids."""
    sets = {i: shingles(text, n) for i, text in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = sets[i], sets[j]
            shared = len(a & b)
            if a and b and 100 * shared >= percent * (len(a) + len(b) - shared):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def viterbi(model, text):
    """Ids of the best path over the whole text; of equal ones the earlier start of a piece wins."""
    text = "▁" + text.replace(" ", "▁") if text else ""
    best, back = [0.0] + [float("-inf")] * len(text), [None] * (len(text) + 1)
    for i in range(len(text)):
        for j in range(i + 1, min(len(text), i + model.longest) + 1):
            score = model.scores.get(text[i:j])
            if score is not None and best[i] + score > best[j]:
                best[j], back[j] = best[i] + score, (i, [model.ids[text[i:j]]])
        if text[i] not in model.ids and best[i] + model.least - 10 > best[i + 1]:
            best[i + 1], back[i + 1] = best[i] + model.least - 10, (i, [model.byte_ids[b] for b in text[i].encode()])
    out, at = [], len(text)
    while at:
        at, ids = back[at]
        out.append(ids)
    return [x for ids in reversed(out) for x in ids]
