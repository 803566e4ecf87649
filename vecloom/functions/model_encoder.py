"""Batch inference with a user-supplied ONNX model under the encoder interface.

The model directory holds ``model.onnx`` and ``tokenizer.json``.  It must be
readable on every executor: a shared mount, or shipped with
``sparkContext.addFile(dir, recursive=True)``.  Each task loads the model once
and encodes texts of similar length together.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.functions.encoders import EncoderSpec, as_float_lists, relist

_BATCH = 32


class _Model:
    """One loaded model: texts in, unit vectors out."""

    def __init__(self, spec: EncoderSpec):
        import onnxruntime
        from tokenizers import Tokenizer

        folder = spec.model_dir
        if not os.path.isdir(folder):
            folder = SparkFiles.get(os.path.basename(folder.rstrip("/")))
        options = onnxruntime.SessionOptions()
        # Spark already runs one task per core.
        options.intra_op_num_threads = options.inter_op_num_threads = 1
        self.session = onnxruntime.InferenceSession(
            os.path.join(folder, "model.onnx"), options, providers=["CPUExecutionProvider"]
        )
        self.tokenizer = Tokenizer.from_file(os.path.join(folder, "tokenizer.json"))
        self.tokenizer.no_padding()
        self.inputs = {i.name for i in self.session.get_inputs()}
        self.spec = spec

    def _tokens(self, text: str) -> list[int]:
        # The limit counts special tokens, so a long text loses its last one.
        ids = self.tokenizer.encode(text).ids
        return ids if self.spec.max_tokens is None else ids[: self.spec.max_tokens]

    def _forward(self, rows: list[list[int]]) -> np.ndarray:
        width = max(1, max(len(r) for r in rows))
        ids = np.zeros((len(rows), width), dtype=np.int64)
        mask = np.zeros_like(ids)
        for i, row in enumerate(rows):
            ids[i, : len(row)], mask[i, : len(row)] = row, 1
        feeds = {"input_ids": ids, "attention_mask": mask, "token_type_ids": np.zeros_like(ids)}
        hidden = self.session.run(None, {k: v for k, v in feeds.items() if k in self.inputs})[0]
        if self.spec.pooling == "cls":
            pooled = hidden[:, 0, :]
        else:
            weights = mask[:, :, None].astype(hidden.dtype)
            pooled = (hidden * weights).sum(axis=1) / np.maximum(weights.sum(axis=1), 1e-9)
        if pooled.shape[1] != self.spec.dim:
            raise ValueError(f"{self.spec.name} gives {pooled.shape[1]} dimensions, not {self.spec.dim}")
        norms = np.sqrt((pooled * pooled).sum(axis=1, keepdims=True))
        return pooled / np.where(norms > 0, norms, 1.0)

    def encode(self, texts: pa.Array) -> np.ndarray:
        """Vectors of a batch; NULL and empty texts stay zero."""
        out = np.zeros((len(texts), self.spec.dim), dtype=np.float32)
        tokens = {i: self._tokens(t) for i, t in enumerate(texts.to_pylist()) if t}
        by_length = sorted(tokens, key=lambda i: len(tokens[i]))
        for start in range(0, len(by_length), _BATCH):
            part = by_length[start : start + _BATCH]
            try:
                out[part] = self._forward([tokens[i] for i in part])
            except Exception:
                if self.spec.strict:
                    raise
                self._one_by_one(part, tokens, out)
        return out

    def _one_by_one(self, part: list[int], tokens: dict[int, list[int]], out: np.ndarray) -> None:
        """Keep the good texts of a failed batch; the others stay zero."""
        for i in part:
            try:
                out[i] = self._forward([tokens[i]])[0]
            except Exception:
                out[i] = 0.0


def model_udf(spec: EncoderSpec):
    """Arrow function from texts to vectors; NULL gives NULL."""

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def run_model(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = _Model(spec)
        for batch in batches:
            yield as_float_lists(model.encode(batch), batch.is_valid().to_numpy(zero_copy_only=False))

    return run_model


def model_batch_udf(spec: EncoderSpec):
    """Arrow function from lists of texts to lists of vectors."""

    @F.arrow_udf(T.ArrayType(T.ArrayType(T.FloatType())))
    def run_model(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = _Model(spec)
        for batch in batches:
            texts = batch.flatten()
            known = texts.is_valid().to_numpy(zero_copy_only=False)
            yield relist(batch, as_float_lists(model.encode(texts), known))

    return run_model
