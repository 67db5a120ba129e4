"""Linear-chain conditional random fields in numpy: posteriors, slopes and best paths of many sequences at once."""

from __future__ import annotations

import numpy as np


def forward_backward(em: np.ndarray, first: np.ndarray, length: np.ndarray, steps: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Posteriors of each row of ``em`` (log potentials); sequence i has rows first[i] .. first[i] + length[i]. All sequences
    advance together, the longest first, so that each step works on a slice."""
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    pot = np.exp(em - em.max(axis=1, keepdims=True))
    move = np.exp(steps - steps.max())
    live = np.searchsorted(-length, -np.arange(length[0]), side="left")
    fore = np.empty_like(pot)
    a = pot[first] * np.exp(start - start.max())
    fore[first] = a = a / a.sum(axis=1, keepdims=True)
    for t in range(1, int(length[0])):
        at = first[:live[t]] + t
        a = (a[:live[t]] @ move) * pot[at]
        a /= a.sum(axis=1, keepdims=True)
        fore[at] = a
    b = np.ones((len(first), pot.shape[1]))
    for t in range(int(length[0]) - 2, -1, -1):
        n = live[t + 1]
        after = first[:n] + t + 1
        b[:n] = (pot[after] * b[:n]) @ move.T
        b[:n] /= b[:n].sum(axis=1, keepdims=True)
        fore[after - 1] *= b[:n]
    return fore / fore.sum(axis=1, keepdims=True)


def slopes(em: np.ndarray, gold: np.ndarray, steps: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected minus observed counts of a batch of equally long sequences: emissions, transitions, starts."""
    n, length, k = em.shape
    pot = np.exp(em - em.max(axis=2, keepdims=True))
    move = np.exp(steps - steps.max())
    fore, back = np.empty_like(pot), np.ones_like(pot)
    fore[:, 0] = pot[:, 0] * np.exp(start - start.max())
    fore[:, 0] /= fore[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, length):
        fore[:, t] = (fore[:, t - 1] @ move) * pot[:, t]
        fore[:, t] /= fore[:, t].sum(axis=1, keepdims=True)
    for t in range(length - 2, -1, -1):
        back[:, t] = (pot[:, t + 1] * back[:, t + 1]) @ move.T
        back[:, t] /= back[:, t].sum(axis=1, keepdims=True)
    post = fore * back
    post /= post.sum(axis=2, keepdims=True)
    both = fore[:, :-1, :, None] * move * (pot[:, 1:] * back[:, 1:])[:, :, None, :]
    both /= both.sum(axis=(2, 3), keepdims=True)
    pairs = both.sum(axis=(0, 1))
    np.add.at(pairs, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), -1)
    starts = post[:, 0].sum(axis=0) - np.bincount(gold[:, 0], minlength=k)
    np.put_along_axis(post, gold[:, :, None], np.take_along_axis(post, gold[:, :, None], 2) - 1, 2)
    return post, pairs, starts


def viterbi(em: np.ndarray, steps: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Best states (n, length) of equally long sequences with log potentials ``em`` (n, length, states)."""
    n, length, k = em.shape
    best = em[:, 0] + start
    came = np.zeros((n, length, k), np.int8)
    for t in range(1, length):
        at = best[:, :, None] + steps
        came[:, t] = at.argmax(axis=1)
        best = at.max(axis=1) + em[:, t]
    path = np.zeros((n, length), np.int8)
    path[:, -1] = best.argmax(axis=1)
    for t in range(length - 1, 0, -1):
        path[:, t - 1] = np.take_along_axis(came[:, t], path[:, t, None].astype(np.int64), 1)[:, 0]
    return path
