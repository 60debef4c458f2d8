"""Languages of texts, one trigram at a time, to compare the operator with."""

import math
import zlib
from collections import Counter, namedtuple

from storesales.llm.language import OVERLAP, PENALTY, SLOT_BITS, SLOTS, SMOOTHING, STEPS

Judged = namedtuple("Judged", "held_out lang score langs shares gain error")


def _trigrams(text):
    """Pairs of slot and middle byte."""
    data = [b if 97 <= b <= 122 or b >= 128 else 32 for b in f" {text} ".lower().encode()]
    runs = [r for r in zip(data, data[1:], data[2:], strict=False) if sum(b != 32 for b in r) >= 2]
    return [(_slot(r), r[1]) for r in runs]


def _slot(run):
    return ((run[0] << 16 | run[1] << 8 | run[2]) * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - SLOT_BITS)


def _fit(counts, sources, shares):
    """EM over the sources (functions of the slot): shares and log-likelihood."""
    total = sum(counts.values())
    for _ in range(STEPS):
        fresh = [0.0] * len(shares)
        for slot, n in counts.items():
            joint = [s * f(slot) for s, f in zip(shares, sources, strict=True)]
            whole = sum(joint)
            for i, j in enumerate(joint):
                fresh[i] += n * j / whole
        shares = [f / total for f in fresh]
    return shares, sum(n * math.log(sum(s * f(slot) for s, f in zip(shares, sources, strict=True))) for slot, n in counts.items())


def by_hand(learned, judged):
    """``Judged`` by id, of rows ``id, text, lang``."""
    seen, middle = {}, Counter()
    for i, text, lang in learned:
        if lang is not None and (i is None or zlib.crc32(str(i).encode()) % 4 != 2):
            grams = _trigrams(text or "")
            seen.setdefault(lang, Counter()).update(s for s, _ in grams)
            middle.update(b for _, b in grams)
    names = sorted(seen)
    totals = [seen[n].total() + SMOOTHING * SLOTS for n in names]
    sources = [lambda slot, c=seen[n], t=t: (c[slot] + SMOOTHING) / t for n, t in zip(names, totals, strict=True)]
    chance = Counter()
    for a in middle:
        for b in middle:
            for c in middle:
                if sum(x != 32 for x in (a, b, c)) >= 2:
                    chance[_slot((a, b, c))] += middle[a] * middle[b] * middle[c]
    every = sum(chance.values()) or 1.0
    out = {}
    for i, text, _ in judged:
        held = i is not None and zlib.crc32(str(i).encode()) % 4 == 2
        counts = Counter(s for s, _ in _trigrams(text or ""))
        if not names or not any(map(str.isalpha, text or "")):
            out[i] = Judged(held, "und", 0.0, [], [], 0.0, 0.0)
            continue
        if not counts:
            out[i] = Judged(held, names[0], 1 / len(names), names, [1 / len(names)] * len(names), 0.0, 0.0)
            continue
        n = counts.total()
        price = PENALTY * math.log(n + 1)
        shares, fit = _fit(counts, sources, [1 / len(names)] * len(names))
        single = [sum(k * math.log(f(slot)) for slot, k in counts.items()) for f in sources]
        if max(single) >= fit - price:
            shares = [0.0] * len(names)
            shares[single.index(max(single))] = 1.0
        else:
            while sum(s > 0 for s in shares) > 1:
                trial = shares.copy()
                trial[min((s, k) for k, s in enumerate(shares) if s > 0)[1]] = 0.0
                trial, trial_fit = _fit(counts, sources, [s / sum(trial) for s in trial])
                if trial_fit < fit - price:
                    break
                shares, fit = trial, trial_fit
        known = [t - SMOOTHING * SLOTS for t in totals]
        drawn = sum(s * k / t for s, k, t in zip(shares, known, totals, strict=True))
        rest = sum(s * SMOOTHING / t for s, t in zip(shares, totals, strict=True))
        gains = {
            slot: math.log(sum(s * f(slot) for s, f in zip(shares, sources, strict=True)))
            - math.log((drawn * chance[slot] / every + rest + 1 / SLOTS) / 2)
            for slot in counts
        }
        mean = sum(k * gains[slot] for slot, k in counts.items()) / n
        spread = sum(k * (gains[slot] - mean) ** 2 for slot, k in counts.items()) / n
        if n <= OVERLAP:
            spread = max(spread, mean**2)
        chosen = sorted((k for k in range(len(names)) if shares[k] > 0), key=lambda k: (-shares[k], k))
        out[i] = Judged(held, names[chosen[0]], shares[chosen[0]], [names[k] for k in chosen], [shares[k] for k in chosen], mean, math.sqrt(spread * OVERLAP / n))
    return out


def line_features(text):
    """Length and features of every line with words, word by word."""
    classes = [set(range(65, 91)), set(range(48, 58)), set(b"#$%&*<>{}[]=+@^~\\/_"), set(b"|"), set(b"!"), set(b".,;:?'\"()-")]
    lines = [(len(raw), raw, raw.split()) for raw in (text or "").encode().split(b"\n")]
    lines = [x for x in lines if x[2]]
    every = [w for _, _, words in lines for w in words]
    runs, seen_runs, seen_lines, out, at = [], set(), set(), [], 0
    for i in range(len(every)):
        run = tuple(every[i : i + 3])
        runs.append(float(len(run) == 3 and run in seen_runs))
        seen_runs.add(run)
    for k, (size, raw, words) in enumerate(lines):
        n = len(words)
        shares = [sum(b in c for b in raw) / size for c in classes]
        stutter = sum(a == b for a, b in zip(words, words[1:], strict=False)) / n
        again = float(tuple(words) in seen_lines)
        seen_lines.add(tuple(words))
        out.append((size, [
            math.log1p(n), math.log1p(size / n), *shares, *(math.sqrt(shares[c]) for c in (0, 2, 3, 4)),
            1 - sum(len(w) == 1 for w in words) / n, stutter, math.sqrt(stutter), sum(runs[at : at + n]) / n,
            again + 0.5 * (k == 0) + 0.25 * (k == len(lines) - 1),
        ]))
        at += n
    return out


def quality(model, text):
    """The score of a text, and how many of its lines are good, from a trained field."""
    lines = line_features(text)
    if not lines:
        return 0.0, 0, 0
    nothing = [0.0] * len(lines[0][1])
    own = [f for _, f in lines]
    logits = []
    for here, before, after in zip(own, [nothing, *own], [*own[1:], nothing], strict=False):
        x = [(v - m) / s for v, m, s in zip([*here, *before, *after], model.mean, model.spread, strict=True)]
        logits.append(sum(v * w for v, w in zip([*x, 1.0], model.weights, strict=True)))
    local = [(1 - 1 / (1 + math.exp(-z)), 1 / (1 + math.exp(-z))) for z in (max(-30, min(30, z)) for z in logits)]
    move = [[math.exp(model.steps[a][b]) for b in (0, 1)] for a in (0, 1)]
    scaled = lambda v: [x / sum(v) for x in v]
    ahead = [scaled(local[0])]
    for one in local[1:]:
        ahead.append(scaled([sum(ahead[-1][a] * move[a][b] for a in (0, 1)) * one[b] for b in (0, 1)]))
    back = [[1.0, 1.0]]
    for one in local[:0:-1]:
        back.append(scaled([sum(move[a][b] * one[b] * back[-1][b] for b in (0, 1)) for a in (0, 1)]))
    good = [scaled([f[k] * b[k] for k in (0, 1)])[1] for f, b in zip(ahead, back[::-1], strict=True)]
    sizes = [s for s, _ in lines]
    return sum(g * s for g, s in zip(good, sizes, strict=True)) / sum(sizes), len(lines), sum(g >= 0.5 for g in good)
