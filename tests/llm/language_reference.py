"""Kneser-Ney models in one process, for characters up to U+FFFF: what tests compare
the model tables with."""

import numpy as np

from threadmill.llm.language_id import ORDER, _codes, _grams, _hash


class Models:
    """Kneser-Ney models of all languages over shared sorted hash arrays."""

    def __init__(self, langs: list[str], counts: list[tuple[np.ndarray, np.ndarray]]):
        self.langs = langs
        L = len(langs)
        #: by order: sorted gram hashes and [gram, language] log-probabilities, sorted contexts and log back-offs
        self.grams, self.logp, self.contexts, self.backoff = {}, {}, {}, {}
        tables = []  # [language][order] -> (codes matrix, counts)
        for packed, n in counts:
            chars = np.stack([(packed >> np.uint64(16 * k)) & np.uint64(0xFFFF) for k in range(ORDER - 1, -1, -1)], 1)
            by_order = {ORDER: (chars, n.astype(float))}
            for o in range(ORDER - 1, 0, -1):
                upper = by_order[o + 1][0]
                u, inv = np.unique(upper[:, 1:], axis=0, return_inverse=True)
                by_order[o] = (u, np.bincount(inv.ravel(), minlength=len(u)).astype(float))  # left contexts
            tables.append(by_order)
        size = len(np.unique(np.concatenate([t[1][0][:, 0] for t in tables]))) + 1
        self.floor = -np.log(size)
        for o in range(1, ORDER + 1):
            hashed = []
            for t in tables:
                m, n = t[o]
                flat = m.ravel()
                ends = np.arange(len(m)) * o + o - 1
                hashed.append((_hash(flat, ends, o), _hash(flat, ends - 1, o - 1) if o > 1 else np.zeros(len(m), np.uint64), n))
            self.grams[o] = np.unique(np.concatenate([h for h, _, _ in hashed]))
            self.contexts[o] = np.unique(np.concatenate([c for _, c, _ in hashed]))
            p = np.zeros((len(self.grams[o]), L))
            bow = np.zeros((len(self.contexts[o]), L))
            for i, (h, c, n) in enumerate(hashed):
                once, twice = (n == 1).sum(), (n == 2).sum()
                discount = once / (once + 2 * twice) if once else 0.5
                ci = np.searchsorted(self.contexts[o], c)
                total = np.bincount(ci, n, len(self.contexts[o]))
                kinds = np.bincount(ci, minlength=len(self.contexts[o]))
                seen = total > 0
                bow[seen, i] = discount * kinds[seen] / total[seen]
                bow[~seen, i] = 1.0
                p[np.searchsorted(self.grams[o], h), i] = np.maximum(n - discount, 0) / total[ci]
            # interpolate with the next lower order, for every stored gram and language
            rep_code, rep_ctx = self._representatives(tables, o)
            lower = np.exp(self._log_prob(rep_code, o - 1)) if o > 1 else np.full((len(rep_code), L), 1.0 / size)
            p += bow[np.searchsorted(self.contexts[o], rep_ctx)] * lower
            self.logp[o] = np.log(np.maximum(p, 1e-12)).astype(np.float32)
            self.backoff[o] = np.log(np.maximum(bow, 1e-12)).astype(np.float32)

    def _representatives(self, tables, o: int) -> tuple[np.ndarray, np.ndarray]:
        """Characters and context hash of each stored gram, in the order of its hash."""
        m = np.concatenate([t[o][0] for t in tables])
        flat, ends = m.ravel(), np.arange(len(m)) * o + o - 1
        h = _hash(flat, ends, o)
        _, first = np.unique(h, return_index=True)
        ctx = _hash(flat, ends - 1, o - 1) if o > 1 else np.zeros(len(m), np.uint64)
        return m[first], ctx[first]

    def _log_prob(self, m: np.ndarray, o: int) -> np.ndarray:
        """Log-probabilities of the last character of each row of ``m`` under order ``o``."""
        flat = m.ravel()
        return self.log_prob(flat, np.arange(len(m)) * m.shape[1] + m.shape[1] - 1, o)

    def log_prob(self, codes: np.ndarray, at: np.ndarray, o: int = ORDER) -> np.ndarray:
        if o == 0:
            return np.full((len(at), len(self.langs)), self.floor, np.float32)
        grams = self.grams[o]
        h = _hash(codes, at, o)
        p = np.minimum(np.searchsorted(grams, h), len(grams) - 1)
        out = self.logp[o][p]
        miss = np.flatnonzero(grams[p] != h)
        if len(miss):
            low = self.log_prob(codes, at[miss], o - 1)
            c = _hash(codes, at[miss] - 1, o - 1) if o > 1 else np.zeros(len(miss), np.uint64)
            ctx = self.contexts[o]
            q = np.minimum(np.searchsorted(ctx, c), len(ctx) - 1)
            low += np.where((ctx[q] == c)[:, None], self.backoff[o][q], 0.0)
            out[miss] = low
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(cross-entropy by character [text, language], has a letter)."""
        codes, owner, has = _codes(texts)
        at, who = _grams(codes, owner)
        out = np.zeros((len(texts), len(self.langs)))
        n = np.maximum(np.bincount(who, minlength=len(texts)), 1)
        # equal grams are looked up once a slice
        h = _hash(codes, at, ORDER)
        _, first, inv = np.unique(h, return_index=True, return_inverse=True)
        p = self.log_prob(codes, at[first])
        for i in range(len(self.langs)):
            out[:, i] = -np.bincount(who, p[:, i][inv], len(texts)) / n
        return out, has
