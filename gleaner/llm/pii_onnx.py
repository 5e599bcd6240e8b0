"""The network of `pii_model` as an ONNX graph, for decoding with onnxruntime; training stays in numpy."""

from __future__ import annotations

import numpy as np

# Field numbers and type codes of the public ONNX schema.
FLOAT, INT64 = 1, 7
_INT, _STRING, _INTS = 2, 3, 7


def _varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def _field(number: int, value: int | str | bytes) -> bytes:
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    raw = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(raw)) + raw


def _tensor(name: str, a: np.ndarray) -> bytes:
    kind = INT64 if a.dtype == np.int64 else FLOAT
    return b"".join(_field(1, d) for d in a.shape) + _field(2, kind) + _field(8, name) + _field(9, np.ascontiguousarray(a).tobytes())


def _attribute(name: str, value: int | str | list[int]) -> bytes:
    head = _field(1, name)
    if isinstance(value, int):
        return head + _field(3, value) + _field(20, _INT)
    if isinstance(value, str):
        return head + _field(4, value) + _field(20, _STRING)
    return head + b"".join(_field(8, x) for x in value) + _field(20, _INTS)


def _node(op: str, inputs: list[str], output: str, **attributes) -> bytes:
    parts = [*[_field(1, x) for x in inputs], _field(2, output), _field(4, op)]
    return b"".join([*parts, *[_field(5, _attribute(k, v)) for k, v in attributes.items()]])


def _info(name: str, kind: int, dims: list[int | str]) -> bytes:
    shape = b"".join(_field(1, _field(2 if isinstance(d, str) else 1, d)) for d in dims)
    return _field(1, name) + _field(2, _field(1, _field(1, kind) + _field(2, shape)))


def graph(p: dict[str, np.ndarray]) -> bytes:
    """ids (T, N) to emissions (T, N, L); p: the parameters of `Model`, gates in the order i, f, g, o."""
    hidden = p["f_wh"].shape[0]

    def gates(w: np.ndarray) -> np.ndarray:  # to the order i, o, f, g
        i, f, g, o = np.split(w, 4, axis=-1)
        return np.concatenate([i, o, f, g], -1)

    none = np.zeros(4 * hidden, np.float32)
    tensors = {
        "emb": p["emb"],
        "w": np.stack([gates(p[f"{d}_wx"]).T for d in "fb"]),
        "r": np.stack([gates(p[f"{d}_wh"]).T for d in "fb"]),
        "b": np.stack([np.concatenate([gates(p[f"{d}_b"]), none]) for d in "fb"]),
        "shape": np.array([0, 0, 2 * hidden], np.int64),
        "out": p["out"],
        "bias": p["bias"],
    }
    nodes = [
        _node("Gather", ["emb", "ids"], "x"),
        _node("LSTM", ["x", "w", "r", "b"], "y", direction="bidirectional", hidden_size=hidden),
        _node("Transpose", ["y"], "yt", perm=[0, 2, 1, 3]),
        _node("Reshape", ["yt", "shape"], "h"),
        _node("MatMul", ["h", "out"], "product"),
        _node("Add", ["product", "bias"], "e"),
    ]
    body = b"".join(_field(1, n) for n in nodes) + _field(2, "pii") + b"".join(_field(5, _tensor(k, v)) for k, v in tensors.items())
    body += _field(11, _info("ids", INT64, ["T", "N"])) + _field(12, _info("e", FLOAT, ["T", "N", p["bias"].shape[0]]))
    return _field(1, 8) + _field(7, body) + _field(8, _field(1, "") + _field(2, 14))


def session(p: dict[str, np.ndarray]):
    """A one-thread inference session, or None where onnxruntime isn't installed."""
    try:
        import onnxruntime
    except ImportError:
        return None
    options = onnxruntime.SessionOptions()
    options.intra_op_num_threads = options.inter_op_num_threads = 1
    return onnxruntime.InferenceSession(graph(p), options, providers=["CPUExecutionProvider"])
