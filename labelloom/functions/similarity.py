"""Token-set similarity of short texts, scored for one block of texts against one block of targets.

Score of two texts split into token sets A and B with shared part I: 100 if I is non-empty and one
set contains the other; otherwise the best normalised insert/delete similarity among I, I+(A-B) and
I+(B-A), each joined in sorted order.

Only the first of these needs a common subsequence. Its length is bounded by the characters both sides
have in common, so a text looks up the targets that share a token with it, takes of the others those
whose length allows the cutoff, bounds the scores of all of them at once, and computes subsequences
from the highest bound downwards until no bound reaches the best score found. No pair that could win or
tie is left out, and texts of any length take the same way.
"""

from __future__ import annotations

import numpy as np
import pandas as pd

# Characters are counted in so many classes; sharing a class only loosens a bound.
CHARACTER_CLASSES = 64


def _masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, ch in enumerate(pattern):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    return masks


def _lcs(pattern: str, text: str, masks: dict[str, int] | None = None) -> int:
    """Longest common subsequence with one bit per pattern character (any length)."""
    masks = _masks(pattern) if masks is None else masks
    full = (1 << len(pattern)) - 1
    state = full
    for ch in text:
        hit = state & masks.get(ch, 0)
        state = ((state + hit) | (state - hit)) & full
    return len(pattern) - bin(state).count("1")


def _similarity(distance, total):
    return 100.0 - 100.0 * distance / total


def pair_score(left: frozenset[str], right: frozenset[str]) -> float:
    """Token-set similarity of two token sets."""
    shared, only_left, only_right = left & right, left - right, right - left
    if shared and (not only_left or not only_right):
        return 100.0
    a, b = " ".join(sorted(only_left)), " ".join(sorted(only_right))
    head = len(" ".join(sorted(shared)))
    glue = 1 if head else 0
    total = 2 * (head + glue) + len(a) + len(b)
    if total == 0:
        return 0.0
    best = _similarity(len(a) + len(b) - 2 * _lcs(a, b), total)
    if head:
        for rest in (a, b):
            best = max(best, _similarity(glue + len(rest), 2 * head + glue + len(rest)))
    return best


def _character_counts(tokens: frozenset[str]) -> np.ndarray:
    codes = np.array([ord(ch) % CHARACTER_CLASSES for token in tokens for ch in token], dtype=np.int64)
    return np.bincount(codes, minlength=CHARACTER_CLASSES).astype(np.int32)


def _gaps(tokens):
    """Spaces between so many tokens."""
    return np.maximum(tokens - 1, 0)


class TargetBlock:
    """Targets in order of preference, with a token index and bounds for the score of a text with each."""

    def __init__(self, texts: list[str]):
        tokens = [frozenset(t.split()) for t in texts]
        by_length = sorted(range(len(texts)), key=lambda row: sum(map(len, tokens[row])) + len(tokens[row]))
        self.preference = np.array(by_length, dtype=np.int64)  # kept by length, so that lengths are a slice
        self.tokens = [tokens[row] for row in by_length]
        self.joined = [" ".join(sorted(t)) for t in self.tokens]
        self.n_tokens = np.array([len(t) for t in self.tokens], dtype=np.int64)
        self.n_chars = np.array([sum(map(len, t)) for t in self.tokens], dtype=np.int64)
        self.lengths = self.n_chars + _gaps(self.n_tokens)
        self.counts = np.array([_character_counts(t) for t in self.tokens], dtype=np.int32).reshape(-1, CHARACTER_CLASSES)
        holders: dict[str, list[int]] = {}
        for row, own in enumerate(self.tokens):
            for token in own:
                holders.setdefault(token, []).append(row)
        self.holders = {token: np.array(rows) for token, rows in holders.items()}
        self.scored = 0  # pairs whose common subsequence was computed

    def best(self, text: str, cutoff: float) -> tuple[int, float] | None:
        """(position, score) of the most similar target with at least `cutoff`; of equals the preferred one."""
        own = frozenset(text.split())
        joined = " ".join(sorted(own))
        n_tokens, n_chars, length = len(own), sum(map(len, own)), len(joined)
        shared_tokens = np.zeros(len(self.tokens), dtype=np.int64)
        shared_chars = np.zeros(len(self.tokens), dtype=np.int64)
        for token in own:
            rows = self.holders.get(token)
            if rows is not None:
                shared_tokens[rows] += 1
                shared_chars[rows] += len(token)
        # Without a shared token the score is at most 200 * shorter / (shorter + longer).
        ratio = cutoff / (200 - cutoff) if 0 < cutoff < 200 else 0.0
        first = np.searchsorted(self.lengths, length * ratio - 1)
        last = np.searchsorted(self.lengths, length / ratio + 1, "right") if ratio else len(self.tokens)
        sharing = np.flatnonzero(shared_tokens)
        rows = np.concatenate([sharing[sharing < first], np.arange(first, max(first, last)), sharing[sharing >= max(first, last)]])
        if not len(rows):
            return None
        shared_tokens, shared_chars = shared_tokens[rows], shared_chars[rows]
        rest, other_rest = n_tokens - shared_tokens, self.n_tokens[rows] - shared_tokens
        a = n_chars - shared_chars + _gaps(rest)
        b = self.n_chars[rows] - shared_chars + _gaps(other_rest)
        head, glue = shared_chars + _gaps(shared_tokens), (shared_tokens > 0).astype(np.int64)
        total = 2 * (head + glue) + a + b
        common = (np.minimum(self.counts[rows], _character_counts(own)).sum(axis=1) - shared_chars
                  + np.minimum(_gaps(rest), _gaps(other_rest)))
        known = np.zeros(len(rows))
        have = np.flatnonzero(glue)
        for side in (a, b):
            known[have] = np.maximum(known[have], _similarity(1 + side[have], 2 * head[have] + 1 + side[have]))
        contained = (glue > 0) & ((rest == 0) | (other_rest == 0))
        known[contained] = 100.0
        bound = np.maximum(known, np.where(total > 0, _similarity(a + b - 2 * common, np.maximum(total, 1)), 0.0))
        least = max(cutoff, float(known.max()))
        open_rows = np.flatnonzero(bound >= least)
        masks = None
        found: tuple[float, int] | None = None  # score, minus the position
        for i in open_rows[np.lexsort((self.preference[rows[open_rows]], -bound[open_rows]))]:
            if found and bound[i] < found[0]:
                break
            score, row = float(known[i]), int(rows[i])
            if not contained[i] and total[i]:
                self.scored += 1
                if glue[i]:
                    lcs = _lcs(" ".join(sorted(own - self.tokens[row])), " ".join(sorted(self.tokens[row] - own)))
                else:
                    masks = _masks(joined) if masks is None else masks
                    lcs = _lcs(joined, self.joined[row], masks)
                score = max(score, float(_similarity(a[i] + b[i] - 2 * lcs, total[i])))
            mine = (score, -int(self.preference[row]))
            if score >= cutoff and (found is None or mine > found):
                found = mine
        return None if found is None else (-found[1], found[0])


def best_matches(texts: pd.DataFrame, targets: pd.DataFrame, cutoff: float) -> pd.DataFrame:
    """Best target per text among those scoring at least the cutoff; ties go to the more frequent one."""
    columns = ["text", "match", "score", "match_count"]
    if texts.empty or targets.empty:
        return pd.DataFrame(columns=columns)
    ordered = targets.sort_values(["count", "text"], ascending=[False, True]).reset_index(drop=True)
    block = TargetBlock(ordered["text"].tolist())
    found = []
    for text in texts["text"]:
        best = block.best(text, cutoff)
        if best is not None:
            found.append((text, ordered["text"][best[0]], best[1], int(ordered["count"][best[0]])))
    return pd.DataFrame(found, columns=columns)
