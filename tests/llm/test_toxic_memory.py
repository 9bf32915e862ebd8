"""Memory of the toxicity features: bounded by a chunk, whatever an Arrow batch holds."""

import tracemalloc

import numpy as np
import pyarrow as pa

from ledgerlens.llm import toxicity
from ledgerlens.llm._features import hash_words, toxic_features
from ledgerlens.llm._text import chunks


def test_features_of_a_large_batch_hold_little():
    texts = [f"row {i} " + "you are a plain w0rd! " * 100 for i in range(4000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    lexicon, odds = hash_words(["plain", "word"]), np.array([4.0, 4.0])
    next(toxicity.features([batch.slice(0, 1)], lexicon, odds))  # tables that stay
    tracemalloc.start()
    got = np.concatenate([x for _, x in toxicity.features([batch], lexicon, odds)])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20
    whole = [toxic_features(data, off, lexicon, odds, toxicity.STRONG) for _, data, off in chunks([batch])]
    np.testing.assert_allclose(got, np.concatenate(whole), rtol=0, atol=1e-9)
