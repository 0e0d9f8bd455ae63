"""Models as functions of batches: recognisers, aligners, enhancers, labellers and embedders plug in here.

A factory is called once in each Python worker and the model it returns is
kept, so loading is not repeated for each batch. The stand-ins are
deterministic and need no weights.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.functions.tables import written

#: Bytes of inputs of a task of a wave.
MOST_BYTES = 1 << 28
Model = Callable[[list], list]
_kept: dict[str, Model] = {}


def apply_model(rows: DataFrame, inputs: list[str], output: str, kind: str, name: str, factory: Callable[[], Model], order: str | None = None, batch: int = 8, at_once: int | None = None, most_bytes: int = MOST_BYTES, keep: list[str] | None = None) -> DataFrame:
    """``output`` from a model over ``inputs``; a batch that fails gives nulls and its reason in ``<output>_problem``.

    ``order``: rows are sorted by it within partitions first, so that a
    batch has inputs of like size. ``at_once``: no more than so many batches
    are with the model at the same time: written rows are dealt into that
    many tasks, wave after wave of files, of about ``most_bytes`` of inputs a task.
    ``keep``: the columns that are handed on beside the output; all of them, if not given.
    """
    if at_once:
        size = reduce(lambda a, b: a + b, (F.coalesce(F.octet_length(c), F.lit(0)) if t in ("string", "binary") else F.lit(8) for c, t in rows.select(*inputs).dtypes))
        dealt = written(rows)
        file = dealt.metadataColumn("_metadata")["file_path"]
        waves: list[list[str]] = []
        room = 0
        for path, n in sorted(dealt.groupBy(file.alias("f")).agg(F.sum(size.cast("long"))).collect()):  # a row for each file
            if not waves or n > room:
                waves.append([])
                room = at_once * most_bytes
            waves[-1].append(path)
            room -= n
        alone = {"inputs": inputs, "output": output, "kind": kind, "name": name, "factory": factory, "order": order, "batch": batch, "keep": keep}
        done = [written(apply_model(dealt.where(file.isin(paths)).repartition(at_once), **alone)) for paths in waves]
        return reduce(DataFrame.unionByName, done) if done else apply_model(dealt, **alone)
    if order:
        rows = rows.sortWithinPartitions(order)
    names = keep or rows.columns

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if name not in _kept:
            _kept[name] = factory()
        model = _kept[name]
        for part in parts:
            out, said = [], []
            for k in range(0, len(part), batch):
                some = list(part[inputs].iloc[k : k + batch].itertuples(index=False, name=None))
                try:
                    found, why = list(model(some)), None
                    if len(found) != len(some):
                        raise ValueError(f"{len(found)} results for {len(some)} inputs")
                except Exception as e:  # noqa: BLE001  a failed batch must not end the job
                    found, why = [None] * len(some), f"{type(e).__name__}: {e}"
                out += found
                said += [why] * len(some)
            made = {output: pd.Series(out, part.index, object), f"{output}_problem": pd.Series(said, part.index, object)}
            yield part[[c for c in names if c not in made]].assign(**made)[[*names, output, f"{output}_problem"]]

    kinds = dict(rows.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in names)
    return rows.mapInPandas(run, f"{schema}, {output} {kind}, {output}_problem string")


def fixed_rate_transcriber(per_second: float = 4.0) -> Model:
    """(signal bytes as float32, rate) -> as many characters as the seconds hold, from a fixed cycle."""
    return lambda rows: ["".join(chr(97 + k % 26) for k in range(int(len(pcm) / 4 / rate * per_second))) for pcm, rate in rows]


def even_aligner() -> Model:
    """(text, duration) -> start times of its characters at equal steps."""
    return lambda rows: [[duration * k / max(len(text), 1) for k in range(len(text))] for text, duration in rows]


def same_enhancer() -> Model:
    return lambda rows: [r[0] for r in rows]


def scripted_labeler(labels: dict[str, str], default: str = "ok") -> Model:
    return lambda rows: [labels.get(str(r[0]), default) for r in rows]


def hashed_embedder(size: int = 16) -> Model:
    """Unit vectors drawn from a hash of the input."""
    def embed(row: tuple) -> list[float]:
        seed = int.from_bytes(hashlib.sha256(repr(row).encode()).digest()[:8], "little")
        v = np.random.default_rng(seed).normal(size=size)
        return (v / np.linalg.norm(v)).tolist()

    return lambda rows: [embed(r) for r in rows]
