"""Linear-chain conditional random field: likelihood with gradient for training, and Viterbi."""

from __future__ import annotations

import numpy as np

FORBIDDEN = -1e4


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def likelihood(scores: np.ndarray, labels: np.ndarray, mask: np.ndarray, start: np.ndarray, trans: np.ndarray):
    """Mean negative log likelihood of sequences, and its gradients.

    scores: (n, t, k) emission scores, labels and mask: (n, t), each row with a filled prefix.
    Returns the loss and the gradients for scores, start and trans.
    """
    n, t, k = scores.shape
    alpha, beta = np.zeros((t, n, k)), np.zeros((t, n, k))
    alpha[0] = start + scores[:, 0]
    for i in range(1, t):
        new = _logsumexp(alpha[i - 1][:, :, None] + trans, 1) + scores[:, i]
        alpha[i] = np.where(mask[:, i, None], new, alpha[i - 1])
    for i in range(t - 2, -1, -1):
        new = _logsumexp(trans + (scores[:, i + 1] + beta[i + 1])[:, None, :], 2)
        beta[i] = np.where(mask[:, i + 1, None], new, beta[i + 1])
    z = _logsumexp(alpha[-1], 1)
    marginal = np.exp(alpha + beta - z[None, :, None]).transpose(1, 0, 2) * mask[..., None]
    gold = np.eye(k)[labels] * mask[..., None]
    d_start, d_trans = (marginal[:, 0] - gold[:, 0]).sum(0), np.zeros((k, k))
    score = start[labels[:, 0]] + (scores * gold).sum((1, 2))
    for i in range(1, t):
        m = mask[:, i].astype(float)
        pair = np.exp(alpha[i - 1][:, :, None] + trans + (scores[:, i] + beta[i])[:, None, :] - z[:, None, None])
        d_trans += (pair * m[:, None, None]).sum(0) - np.einsum("na,nb->ab", gold[:, i - 1] * m[:, None], gold[:, i])
        score += trans[labels[:, i - 1], labels[:, i]] * m
    return (z - score).mean(), (marginal - gold) / n, d_start / n, d_trans / n


def viterbi(scores: np.ndarray, lengths: np.ndarray, start: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Best labels of sequences laid end to end; all sequences advance together, longest first.

    Ties go to the smaller label. Sequences may have any length, none included.
    """
    first = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    out = np.zeros(len(scores), np.int64)
    if not len(order):
        return out
    at, left = first[order], lengths[order]
    back = np.zeros(scores.shape, np.int8)
    best = start + scores[at]
    live, final = len(order), np.zeros((len(order), scores.shape[1]))
    for i in range(1, int(left[0]) + 1):
        now = int(np.searchsorted(-left, -i, side="left"))  # those longer than i go on
        final[now:live] = best[now:live]
        if not now:
            break
        options = best[:now, :, None] + trans
        back[at[:now] + i] = options.argmax(1)
        best = options.max(1) + scores[at[:now] + i]
        live = now
    state, place = final.argmax(1), at + left - 1
    for _ in range(int(left[0])):
        out[place] = state
        on = place > at
        if not on.any():
            break
        keep = int(on.sum())  # longest first: the ones that go on are a prefix
        state, place, at = back[place[:keep], state[:keep]].astype(np.int64), place[:keep] - 1, at[:keep]
    return out


class Adam:
    """Adam steps on a dict of arrays."""

    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.n = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.n += 1
        for k, g in grads.items():
            self.m[k] = 0.9 * self.m[k] + 0.1 * g
            self.v[k] = 0.999 * self.v[k] + 0.001 * g * g
            self.params[k] -= self.rate * (self.m[k] / (1 - 0.9**self.n)) / (np.sqrt(self.v[k] / (1 - 0.999**self.n)) + 1e-8)
