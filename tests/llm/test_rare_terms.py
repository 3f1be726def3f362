"""Terms that few labelled documents have."""

import numpy as np

from demandloom.llm import toxicity


def test_rare_terms_count_however_many_labels_there_are():
    """Six of 3000 documents are toxic, by a term that only they have."""
    terms = toxicity.Terms()
    texts = [f"plain words {'vile' if i < 6 else 'fine'}" for i in range(3000)]
    found = [terms.of(t) for t in texts]
    flat, ends, none = np.concatenate(found), np.array([len(x) for x in found]), np.empty((3000, 0))
    y = np.array([1.0] * 6 + [0.0] * 2994)
    w = toxicity.fit(flat, ends, none, y)
    vile, plain = terms.of("vile"), terms.of("plain")
    assert w[np.setdiff1d(vile, plain)].min() > 0
