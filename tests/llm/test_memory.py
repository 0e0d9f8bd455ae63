"""What Python workers hold from one stage of the pipeline to the next."""

import pyarrow as pa

from loomwright.llm import bytesets, packing, repeats, token_counts, toxicity


def steps(monkeypatch, docs, make):
    """The Python functions that ``make`` hands to Spark."""
    found = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, schema: found.append(f) or self)
    make(docs)
    return found


def test_a_worker_drops_the_tables_of_other_stages(spark, monkeypatch, no_docs):
    import numpy as np
    import public_tokenizers

    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["a b c", None])], ["doc_id", "text"])
    (pieces,) = steps(monkeypatch, no_docs, lambda d: packing.token_pieces(d, public_tokenizers.path("word_bpe_49k.json")))
    (scored,) = steps(monkeypatch, no_docs, lambda d: toxicity.score(d, (np.array([3]), np.array([0.5]), 0.0)))
    repeats._power(8)
    assert sum(b.num_rows for b in pieces(iter([batch]))) == 2
    assert token_counts.loaded and not repeats._powers
    assert sum(b.num_rows for b in scored(iter([batch]))) == 2
    assert not any(bytesets.TABLES)
