"""Plain versions of what the operators do at scale."""

import collections
import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode())


def cut(texts, window):
    """(words, which words go) of each text."""
    all_words = [words(t) for t in texts]
    times = collections.Counter(tuple(w[i : i + window]) for w in all_words for i in range(len(w) - window + 1))
    out = []
    for w in all_words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if times[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((w, gone))
    return out


def shingles(text, size=5):
    w = words(text)
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def groups(texts):
    """(group, links) of each text by its place: least place of its near-duplicate group, linked texts."""
    sets = [shingles(t) for t in texts]
    label, links = list(range(len(texts))), [0] * len(texts)

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 5 * common >= 4 * (len(sets[i]) + len(sets[j]) - common):
                links[i] += 1
                links[j] += 1
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(texts))], links


def targets(sizes, weights=(5, 2, 1), epochs=3):
    """Target of each source (None last), resharing what is above the limit until nothing is."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, left, open_ = {}, float(sum(sizes.values())), set(order)
    while open_:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > epochs * sizes[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = float(epochs * sizes[s])
            left -= out[s]
        open_ -= over
    return out


def greedy(word, pieces, longest):
    """Tokens of a word by longest match; a byte without a piece is a token."""
    at = count = 0
    while at < len(word):
        step = next((n for n in range(min(longest, len(word) - at), 0, -1) if word[at : at + n] in pieces), 1)
        at, count = at + step, count + 1
    return count
