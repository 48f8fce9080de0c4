"""Linear classifiers in numpy."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Adam:
    def __init__(self, n: int, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(n), np.zeros(n), 0, rate

    def step(self, grad: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m += 0.1 * (grad - self.m)
        self.v += 0.001 * (grad * grad - self.v)
        return self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


class Logistic:
    """Logistic regression on dense features, standardised, with an intercept and a ridge penalty, by Newton steps."""

    def __init__(self, ridge: float = 1e-2, steps: int = 25):
        self.ridge, self.steps = ridge, steps

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> Logistic:
        weight = np.ones(len(y)) if weight is None else weight
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-9
        z = np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))])
        self.w = np.zeros(z.shape[1])
        penalty = np.full(len(self.w), self.ridge * len(x) / 100 + 1e-6)
        penalty[-1] = 1e-6
        for _ in range(self.steps):
            p = sigmoid(z @ self.w)
            grad = z.T @ (weight * (p - y)) + penalty * self.w
            h = (z * (weight * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ z + np.diag(penalty)
            delta = np.linalg.solve(h, grad)
            self.w -= delta * min(1.0, 4.0 / (np.abs(delta).max() + 1e-12))
            if np.abs(delta).max() < 1e-6:
                break
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(((x - self.mean) / self.scale) @ self.w[:-1] + self.w[-1], -30, 30)


class Sparse:
    """Rows of indices into features that are present or not."""

    def __init__(self, rows: list[np.ndarray], width: int):
        self.width, self.size = width, np.array([len(r) for r in rows], dtype=np.int64)
        self.index = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64)
        self.row = np.repeat(np.arange(len(rows)), self.size)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.index], minlength=len(self.size))

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.index, weights=g[self.row], minlength=self.width)

    def counts(self) -> np.ndarray:
        return np.bincount(self.index, minlength=self.width)


def fit_nnpu(positive: Sparse, unlabelled: Sparse, prior: float, rounds: int = 400, rate: float = 0.05, ridge: float = 1e-5, slack: float = 0.0) -> np.ndarray:
    """Weights (the last is the intercept) that minimise the non-negative positive-unlabelled risk with the logistic loss.

    The risk is prior * E_p[l(+)] + max(0, E_u[l(-)] - prior * E_p[l(-)]). Where the second part falls under -slack the
    step goes against it, which keeps the classifier from paying for its risk with a negative estimate.
    """
    w = np.zeros(positive.width + 1)
    w[-1] = np.log(prior / (1 - prior))
    adam = Adam(len(w), rate)
    n_p, n_u = len(positive.size), len(unlabelled.size)
    for _ in range(rounds):
        zp, zu = positive.times(w[:-1]) + w[-1], unlabelled.times(w[:-1]) + w[-1]
        sp, su = sigmoid(zp), sigmoid(zu)
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        gp_plus, gp_minus, gu = prior * (sp - 1) / n_p, -prior * sp / n_p, su / n_u
        if negative >= -slack:
            gp, gu_ = gp_plus + gp_minus, gu
        else:
            gp, gu_ = -gp_minus, -gu
        grad = np.append(positive.back(gp) + unlabelled.back(gu_), gp.sum() + gu_.sum())
        grad[:-1] += ridge * w[:-1]
        w -= adam.step(grad)
    return w
