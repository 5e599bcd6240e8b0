"""Character-level bidirectional LSTM with CRF transitions, in numpy: training and decoding.

Labels are O and, for each kind, B- and I-. The network runs over overlapping windows; where two
overlap, their emissions are averaged, the nearer to a window's edge the less it counts. The best
path is then searched over the whole text, so that windows never disagree.
"""

from __future__ import annotations

import io
import pkgutil
from pathlib import Path

import numpy as np

from gleaner.llm.pii_grammar import KINDS, fold
from gleaner.llm.pii_onnx import session

LABELS = ["O", *[f"{p}-{k}" for k in KINDS for p in "BI"]]
L = len(LABELS)
WINDOW, OVERLAP = 320, 32
BLOCK, SEAM = 1 << 20, 1024  # longer texts are decoded in blocks that share SEAM characters
WEIGHTS = Path(__file__).with_name("pii_weights.npz")


def allowed() -> np.ndarray:
    """0 for possible label pairs, a large negative score for I- without its kind before."""
    out = np.zeros((L + 1, L), np.float32)  # the last row: start of a window, where a span may go on
    for j, name in enumerate(LABELS):
        if name[0] == "I":
            for i, before in enumerate(LABELS):
                if before[2:] != name[2:] or before == "O":
                    out[i, j] = -1e4
    return out


class Alphabet:
    """Ids of characters: frequent ones have their own, the rest one by class."""

    def __init__(self, chars: str):
        self.chars = chars
        self.size = len(chars) + 16
        self.table = np.zeros(0x110000, np.int16)
        t = self.table
        t[:] = 1
        t[0x20] = 2
        t[0x80:0x250] = 3
        t[0xC0:0xDF] = 4
        t[0x370:0x600] = 5
        t[0x3040:0x3100] = 6
        t[0x3400:0xA000] = 7
        t[0x3000:0x3040] = 8
        t[0xFF00:0xFFF0] = 9
        t[0x2000:0x2070] = 10
        t[0x1F000:0x20000] = 11
        for i, c in enumerate(chars):
            t[ord(c)] = 16 + i
        t[0x30:0x3A] = 12  # which digit it is doesn't matter

    def ids(self, text: str) -> np.ndarray:
        return self.table[np.frombuffer(fold(text).encode("utf-32-le", "surrogatepass"), np.uint32)]


def _spans(y: np.ndarray) -> list[tuple[int, int, str]]:
    """(start, end, kind) of labels; an I- after another label opens a span of its own."""
    own: list[tuple[int, int, str]] = []
    if y.any():
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (y + 1) // 2, [0]])) | np.concatenate([(y % 2 == 1) & (y > 0), [False]]))
        own = [(int(a), int(b), KINDS[(y[a] - 1) // 2]) for a, b in zip(edges, edges[1:]) if y[a]]
    return own


_TANH_STEP = 512
_TANH = np.tanh((np.arange(8192) - 4096) / _TANH_STEP).astype(np.float32)


class Model:
    """Parameters: emb (V, E); per direction wx (E, 4H), wh (H, 4H), b; out (2H, L), bias; trans (L + 1, L)."""

    def __init__(self, params: dict[str, np.ndarray], chars: str):
        self.p = {k: v.astype(np.float32) for k, v in params.items()}
        self.alphabet = Alphabet(chars)
        self.hidden = self.p["f_wh"].shape[0]
        self.mask = allowed()
        self.session = None
        self.ready = False

    @classmethod
    def new(cls, chars: str, emb: int = 16, hidden: int = 24, seed: int = 7) -> Model:
        rng = np.random.default_rng(seed)
        g = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s).astype(np.float32)
        size = len(chars) + 16
        p = {"emb": rng.normal(0, 0.3, (size, emb)).astype(np.float32), "out": g(2 * hidden, L), "bias": np.zeros(L, np.float32), "trans": np.zeros((L + 1, L), np.float32)}
        for d in "fb":
            p |= {f"{d}_wx": g(emb, 4 * hidden), f"{d}_wh": g(hidden, 4 * hidden), f"{d}_b": np.zeros(4 * hidden, np.float32)}
            p[f"{d}_b"][hidden : 2 * hidden] = 1.0  # forget gate
        return cls(p, chars)

    @classmethod
    def load(cls, at: Path | str | None = None) -> Model:
        """The model of a file, or the one that comes with the package (also where that is an archive)."""
        source = at if at is not None else io.BytesIO(pkgutil.get_data(__package__, WEIGHTS.name))
        with np.load(source, allow_pickle=False) as z:
            return cls({k: z[k] for k in z.files if k != "chars"}, str(z["chars"]))

    def save(self, at: Path | str = WEIGHTS) -> None:
        np.savez_compressed(at, chars=np.array(self.alphabet.chars), **{k: v.astype(np.float16) for k, v in self.p.items()})

    # --- forward -----------------------------------------------------------------------------

    def _run(self, x: np.ndarray, d: str, keep: bool):
        """Hidden states (T, N, H) of one direction over ids (T, N)."""
        h4 = self.p[f"{d}_wh"].shape[1]
        n, hid = x.shape[1], self.hidden
        table = self.p["emb"] @ self.p[f"{d}_wx"] + self.p[f"{d}_b"]  # a lookup instead of a product per character
        wh = self.p[f"{d}_wh"]
        h, c = np.zeros((n, hid), np.float32), np.zeros((n, hid), np.float32)
        out = np.empty((x.shape[0], n, hid), np.float32)
        saved = []
        scale = np.full(h4, 0.5, np.float32)
        scale[2 * hid : 3 * hid] = 1.0  # gates i, f, g, o: sigmoid as a scaled tanh, one call for all
        for t in range(x.shape[0]) if d == "f" else range(x.shape[0] - 1, -1, -1):
            z = h @ wh
            z += table[x[t]]
            z *= scale
            np.tanh(z, out=z)
            i, f, g, o = 0.5 * z[:, :hid] + 0.5, 0.5 * z[:, hid : 2 * hid] + 0.5, z[:, 2 * hid : 3 * hid], 0.5 * z[:, 3 * hid :] + 0.5
            before = (h, c)
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[t] = h
            if keep:
                saved.append((t, *before, i, f, g.copy(), o, tc))
        return out, saved

    def _states(self, x: np.ndarray, d: str) -> np.ndarray:
        """As _run, for decoding only: gates in arrays of their own, activations from a table (off by at most 0.002)."""
        hid, n = self.hidden, x.shape[1]
        scale = np.full(4 * hid, 0.5 * _TANH_STEP, np.float32)
        scale[2 * hid : 3 * hid] = _TANH_STEP
        table = (self.p["emb"] @ self.p[f"{d}_wx"] + self.p[f"{d}_b"]) * scale + (len(_TANH) / 2 + 0.5)
        tables = [np.ascontiguousarray(table[:, k * hid : (k + 1) * hid], np.float32) for k in range(4)]
        weights = [np.ascontiguousarray((self.p[f"{d}_wh"] * scale)[:, k * hid : (k + 1) * hid]) for k in range(4)]
        gates = [np.empty((n, hid), np.float32) for _ in range(4)]
        h, c = np.zeros((n, hid), np.float32), np.zeros((n, hid), np.float32)
        near, place = np.empty((n, hid), np.float32), np.empty((n, hid), np.int32)
        out = np.empty((x.shape[0], n, hid), np.float32)
        for t in range(x.shape[0]) if d == "f" else range(x.shape[0] - 1, -1, -1):
            for z, w, own in zip(gates, weights, tables):
                np.matmul(h, w, out=z)
                np.take(own, x[t], axis=0, out=near, mode="clip")
                z += near
                place[:] = z
                np.take(_TANH, place, out=z, mode="clip")
            i, f, g, o = gates
            f += 1
            f *= c
            i += 1
            i *= g
            np.add(f, i, out=c)
            c *= 0.5
            np.multiply(c, _TANH_STEP, out=near)
            near += len(_TANH) / 2 + 0.5
            place[:] = near
            np.take(_TANH, place, out=near, mode="clip")
            o += 1
            o *= 0.5
            np.multiply(o, near, out=h)
            out[t] = h
        return out

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """(T, N, L) for ids (T, N)."""
        if not self.ready:
            self.session, self.ready = session(self.p), True
        if self.session is not None:
            return self.session.run(None, {"ids": x.astype(np.int64)})[0]
        x = x.astype(np.int64)
        f, b = self._states(x, "f"), self._states(x, "b")
        hid = self.hidden
        return f @ self.p["out"][:hid] + b @ self.p["out"][hid:] + self.p["bias"]

    def viterbi(self, e: np.ndarray) -> np.ndarray:
        """Best labels (T, N) of emissions (T, N, L)."""
        trans = self.p["trans"] + self.mask
        steps, n, _ = e.shape
        scores = np.empty((steps, L, n), np.float32)  # labels before rows: maxima over the first axis are fast
        into = np.ascontiguousarray(trans[:L].T)
        kinds = np.arange(len(KINDS))
        open_, go_on = trans[2 * kinds + 1, 2 * kinds + 2][:, None], trans[2 * kinds + 2, 2 * kinds + 2][:, None]
        scores[0] = e[0].T + trans[L][:, None]
        sums = np.empty((L, n), np.float32)
        for t in range(1, steps):
            before, now = scores[t - 1], scores[t]
            np.maximum(before[1::2] + open_, before[2::2] + go_on, out=now[2::2])  # I- follows its own kind only
            for j in (0, *range(1, L, 2)):
                np.add(before, into[j][:, None], out=sums)
                np.maximum.reduce(sums, axis=0, out=now[j])
            now += e[t].T
        out = np.empty((steps, n), np.int8)
        out[-1] = scores[-1].argmax(0)
        for t in range(steps - 1, 0, -1):
            out[t - 1] = (scores[t - 1] + into[out[t]].T).argmax(0)
        return out

    def blended(self, ids: list[np.ndarray], at_once: int = 256) -> list[np.ndarray]:
        """Emissions (n, L) of each sequence of ids, averaged where windows overlap."""
        step = WINDOW - OVERLAP
        cuts = [(k, s) for k, x in enumerate(ids) for s in range(0, max(1, len(x) - OVERLAP), step)]
        cuts.sort(key=lambda c: min(WINDOW, len(ids[c[0]]) - c[1]))  # windows of like length together
        out = [np.zeros((len(x), L), np.float32) for x in ids]
        rise = ((np.arange(OVERLAP) + 0.5) / OVERLAP).astype(np.float32)[:, None]
        for a in range(0, len(cuts), at_once):
            part = cuts[a : a + at_once]
            width = max(1, *[min(WINDOW, len(ids[k]) - s) for k, s in part], 1)
            x = np.full((width, len(part)), 2, np.int16)
            for j, (k, s) in enumerate(part):
                w = ids[k][s : s + width]
                x[: len(w), j] = w
            e = self.emissions(x)
            for j, (k, s) in enumerate(part):
                n = min(WINDOW, len(ids[k]) - s)
                own = e[:n, j]
                if s:
                    own[:OVERLAP] *= rise[:n]
                if s + WINDOW < len(ids[k]):
                    own[-OVERLAP:] *= 1 - rise
                out[k][s : s + n] += own
        return out

    def label(self, texts: list[str], lead: float = 4.0) -> list[np.ndarray]:
        """Labels of each text's characters: the best path over the whole text.

        The path is searched in pieces that end where O leads by at least `lead` over every other
        label; where there is no such place, a piece goes on.
        """
        ids = [self.alphabet.ids(t) for t in texts]
        emitted = self.blended(ids)
        out = [np.zeros(len(x), np.int8) for x in ids]
        parts = []
        for k, e in enumerate(emitted):
            start, n = 0, len(e)
            margin = e[:, 0] - e[:, 1:].max(1) if n > WINDOW else None
            while n - start > WINDOW:
                cut = 0
                for at in range(start + WINDOW // 2, n, WINDOW // 2):
                    best = at + int(margin[at : at + WINDOW // 2].argmax())
                    if margin[best] >= lead:
                        cut = best
                        break
                if not cut:
                    break
                parts.append((start, cut, k))
                start = cut
            if n > start:
                parts.append((start, n, k))
        parts.sort(key=lambda c: c[1] - c[0])
        while parts:
            longest = 64 + parts[0][1] - parts[0][0]  # like lengths together
            some = [c for c in parts[:1024] if c[1] - c[0] <= longest]
            parts = parts[len(some) :]
            width = some[-1][1] - some[-1][0]
            e = np.full((width, len(some), L), -1e4, np.float32)
            e[:, :, 0] = 0
            for j, (a, b, k) in enumerate(some):
                e[: b - a, j] = emitted[k][a:b]
            y = self.viterbi(e)
            for j, (a, b, k) in enumerate(some):
                out[k][a:b] = y[: b - a, j]
        return out

    def spans(self, texts: list[str]) -> list[list[tuple[int, int, str]]]:
        """(start, end, kind) of each text, by its characters."""
        blocks = [(k, s) for k, t in enumerate(texts) for s in range(0, max(1, len(t) - SEAM), BLOCK)]
        found: list[list[tuple[int, int, str]]] = [[] for _ in texts]
        held: list[tuple[int, int]] = []
        size = 0
        for i, (k, s) in enumerate(blocks):
            held.append((k, s))
            size += min(BLOCK + SEAM, len(texts[k]) - s)
            if i + 1 < len(blocks) and size < BLOCK:
                continue  # as many texts at once as make up a block
            for (k, s), y in zip(held, self.label([texts[k][s : s + BLOCK + SEAM] for k, s in held])):
                last = s + BLOCK + SEAM >= len(texts[k])
                for a, b, kind in _spans(y):
                    if a >= (SEAM // 2 if s else 0) and (last or a < BLOCK + SEAM // 2):
                        found[k].append((s + a, s + b, kind))
            held, size = [], 0
        return found

    # --- training ----------------------------------------------------------------------------

    def loss_and_gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """CRF loss per character and gradients; x, y: (T, N)."""
        p, hid = self.p, self.hidden
        f, saved_f = self._run(x, "f", True)
        b, saved_b = self._run(x, "b", True)
        hs = np.concatenate([f, b], 2)
        e = hs @ p["out"] + p["bias"]
        steps, n, _ = e.shape
        trans = p["trans"] + self.mask
        lse = lambda s, axis: (m := s.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(s - m).sum(axis))
        alpha = np.empty_like(e)
        alpha[0] = e[0] + trans[L]
        for t in range(1, steps):
            alpha[t] = lse(alpha[t - 1][:, :, None] + trans[:L][None], 1) + e[t]
        beta = np.zeros_like(e)
        for t in range(steps - 2, -1, -1):
            beta[t] = lse(trans[:L][None] + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        log_z = lse(alpha[-1], 1)
        rows = np.arange(n)
        gold = sum(e[t][rows, y[t]] for t in range(steps)) + trans[L, y[0]] + sum(trans[y[t - 1], y[t]] for t in range(1, steps))
        de = np.exp(alpha + beta - log_z[None, :, None])
        d_trans = np.zeros_like(p["trans"])
        d_trans[L] = de[0].sum(0)
        np.subtract.at(d_trans, (np.full(n, L), y[0]), 1)
        for t in range(1, steps):
            pair = alpha[t - 1][:, :, None] + trans[:L][None] + (e[t] + beta[t])[:, None, :] - log_z[:, None, None]
            d_trans[:L] += np.exp(pair).sum(0)
            np.subtract.at(d_trans, (y[t - 1], y[t]), 1)
        for t in range(steps):
            de[t][rows, y[t]] -= 1
        count = steps * n
        de /= count
        g = {"trans": d_trans / count, "out": np.einsum("tnh,tnl->hl", hs, de), "bias": de.sum((0, 1)), "emb": np.zeros_like(p["emb"])}
        dh_all = de @ p["out"].T
        for d, saved, dh_d in (("f", saved_f, dh_all[:, :, :hid]), ("b", saved_b, dh_all[:, :, hid:])):
            wh, wx = p[f"{d}_wh"], p[f"{d}_wx"]
            d_wh, d_table = np.zeros_like(wh), np.zeros((p["emb"].shape[0], 4 * hid), wh.dtype)
            d_z = np.empty((steps, n, 4 * hid), wh.dtype)
            dh, dc = np.zeros((n, hid), np.float32), np.zeros((n, hid), np.float32)
            for t, h0, c0, i, fg, gg, o, tc in reversed(saved):
                dh = dh + dh_d[t]
                dc = dc + dh * o * (1 - tc * tc)
                dz = np.concatenate([dc * gg * i * (1 - i), dc * c0 * fg * (1 - fg), dc * i * (1 - gg * gg), dh * tc * o * (1 - o)], 1)
                d_wh += h0.T @ dz
                d_z[t] = dz
                dh, dc = dz @ wh.T, dc * fg
            by_char = np.argsort(x, axis=None, kind="stable")
            chars, first = np.unique(x.ravel()[by_char], return_index=True)
            d_table[chars] = np.add.reduceat(d_z.reshape(-1, 4 * hid)[by_char], first, axis=0)
            g[f"{d}_wh"], g[f"{d}_wx"], g[f"{d}_b"] = d_wh, p["emb"].T @ d_table, d_table.sum(0)
            g["emb"] += d_table @ wx.T
        return float((log_z - gold).sum() / count), g
