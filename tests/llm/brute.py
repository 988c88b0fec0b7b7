"""Plain single-process versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import html
import math
import re
import zlib
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def windowed(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def targets(sizes, weights=(1, 2, 3), cap=3):
    """source -> target; sizes: source -> words."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in full]
        level = (total - sum(full.values())) / max(1e-300, sum(w[s] for s in rest)) if rest else 0
        over = [s for s in rest if level * w[s] > cap * sizes[s] + 1e-9]
        if not over:
            return {s: full.get(s, level * w[s]) for s in order}
        for s in over:
            full[s] = cap * sizes[s]


def sainte_lague(votes, seats):
    won = dict.fromkeys(votes, 0)
    for _ in range(seats):
        best = min(votes, key=lambda k: (-votes[k] / (2 * won[k] + 1), k))
        won[best] += 1
    return won


def contamination(docs, bench, width=13):
    """(doc_id, text) and (item_id, text) rows -> list of (doc_id, n_words, n_hit, items)."""
    tests = defaultdict(set)
    for item, text in bench:
        w = windowed(text)
        k = min(width, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            tests[tuple(w[i : i + k])].add(None if item is None else str(item))
    lengths = {len(t) for t in tests}
    out = []
    for doc, text in docs:
        w, hit, items = windowed(text), set(), set()
        for k in lengths:
            for i in range(len(w) - k + 1):
                found = tests.get(tuple(w[i : i + k]))
                if found:
                    hit.update(range(i, i + k))
                    items |= found - {None}
        out.append((doc, len(w), len(hit), sorted(items)))
    return out


def items_hash(items):
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def jaccard_groups(docs, n=5, percent=80):
    """(doc_id, text) rows -> (set, some place of its group) of each row."""
    sets = []
    for _, text in docs:
        w = spaced(text)
        sets.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    at = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            at[g].append(i)
    common = Counter((a, b) for rows in at.values() for x, b in enumerate(rows) for a in rows[:x])
    up = list(range(len(docs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for (a, b), c in common.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            up[root(a)] = root(b)
    return [(s, root(i)) for i, s in enumerate(sets)]


def jaccard_components(docs, n=5, percent=80):
    """(doc_id, text) rows -> list of (doc_id, set size, component)."""
    found = jaccard_groups(docs, n, percent)
    groups = defaultdict(list)
    for (doc, _), (_, g) in zip(docs, found, strict=True):
        groups[g].append(doc)
    least = {g: min((d for d in ds if d is not None), default=None) for g, ds in groups.items()}
    return [(doc, len(s), least[g] if s else doc) for (doc, _), (s, g) in zip(docs, found, strict=True)]


def one_of_each(docs, n=5, percent=80):
    """(doc_id, text) rows -> for each group the texts that may stay, under the doc_id that stays; rows without n-grams alone."""
    groups = defaultdict(list)
    for i, ((doc, text), (s, g)) in enumerate(zip(docs, jaccard_groups(docs, n, percent), strict=True)):
        groups[g if s else ("none", i)].append((doc is None, doc, text))
    least = [(min(x[:2] for x in rows), rows) for rows in groups.values()]
    return [(doc, {t for *k, t in rows if k == [late, doc]}) for (late, doc), rows in least]


def dedup_words(docs, min_words=50):
    """(doc_id, text) rows with distinct ids -> {doc_id: words without later repeated passages}."""
    first, places = {}, []
    for doc, text in sorted(docs, key=lambda d: (d[0] is None, d[0])):
        w = (text or "").split()
        for i in range(len(w) - min_words + 1):
            here = first.setdefault(tuple(w[i : i + min_words]), (doc, i))
            places.append((doc, i, here))
    gone = {(doc, i + k) for doc, i, (d, j) in places if d != doc or i >= j + min_words for k in range(min_words)}
    return {doc: [x for i, x in enumerate((text or "").split()) if (doc, i) not in gone] for doc, text in docs}


def dedup_lines(docs, min_words=50):
    """(doc_id, text) rows with distinct ids -> {doc_id: text without later repeated runs}."""
    first, places = {}, []
    for doc, text in sorted(docs):
        lines = [tuple(x.split()) for x in text.split("\n")]
        for start in range(len(lines)):
            held = 0
            for stop in range(start, len(lines)):
                held += len(lines[stop])
                if held < min_words:
                    continue
                if held - len(lines[start]) < min_words or held - len(lines[stop]) < min_words:
                    run = tuple(lines[start : stop + 1])
                    first.setdefault(run, (doc, start, stop))
                    places.append((doc, start, stop, run))
    gone = defaultdict(set)
    for doc, start, stop, run in places:
        d, s, e = first[run]
        if d != doc or start > e:
            gone[doc].update(range(start, stop + 1))
    return {doc: "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone[doc]) for doc, text in docs}


def held_out(doc_id, folds):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == 0


def lm_scores(docs, mu, folds=10):
    """(doc_id, text) rows -> list of (n_tokens, n_known, N, base, score)."""
    tokens = [spaced(text) + [None] for _, text in docs]
    one, two = Counter(), Counter()
    for (doc, _), t in zip(docs, tokens, strict=True):
        if not held_out(doc, folds):
            one.update(t)
            two.update(zip([None, *t[:-1]], t, strict=True))
    n, v = sum(one.values()), len(one)
    p = lambda w: (one[w] + 0.1) / (n + 0.1 * (v + 1))
    out = []
    for t in tokens:
        base = sum(math.log10(p(w)) for w in t)
        score = sum(math.log10((two[c, w] + mu * p(w)) / (one[c] + mu)) for c, w in zip([None, *t[:-1]], t, strict=True))
        out.append((len(t), sum(one[w] > 0 for w in t), n, base, score))
    return out


def article_text(page):
    """Main text of the given pages, whose main text is their only article."""
    inside = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inside))).split())


def hard_negatives(rows, is_anchor, k=5, low=80, scale=256):
    """(vec_id, vector, label) rows -> set of (anchor, positive, rank, negative, positive score, negative score)."""
    ok = lambda v: v and all(x is not None and math.isfinite(x) for x in v)
    one = {}
    for i, v, label in rows:
        if i is not None and label is not None and ok(v):
            entry = (label, [math.floor(scale * x) for x in v])
            one[i] = min(one.get(i, entry), entry)
    lengths = Counter(len(v) for _, v in one.values())
    dim = max(lengths, key=lambda n: (lengths[n], n), default=0)
    one = {i: e for i, e in one.items() if len(e[1]) == dim}
    out = set()
    for a, (label, v) in one.items():
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i, other) for i, (other, w) in one.items() if i != a)
        for s, p, _ in [x for x in scored if x[2] == label][:k]:
            fit = [(t, n) for t, n, other in scored if other != label and low * -s <= 100 * -t <= 100 * -s]
            out |= {(a, p, r, n, -s, -t) for r, (t, n) in enumerate(fit[:k], 1)}
    return out


def spelling(docs, typo_every=31, min_length=7, min_count=2, factor=10):
    """(doc_id, text) rows -> set of (word, form, root, n, n_near, form_n)."""
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if typo_every and h % typo_every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    near = defaultdict(set)
    gaps = defaultdict(list)
    for w in words:
        for i in range(len(w)):
            gaps[w[:i], w[i + 1 :]].append(w)
            if w[:i] + w[i + 1 :] in words:
                near[w].add(w[:i] + w[i + 1 :])
                near[w[:i] + w[i + 1 :]].add(w)
    for same in gaps.values():
        for w in same:
            near[w].update(x for x in same if x != w)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= factor * n:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}
