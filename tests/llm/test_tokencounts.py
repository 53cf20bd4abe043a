import numpy as np
from tokenizers import Tokenizer
from words import documents, prose  # noqa: F401

from cargolens.llm import tokencounts
from cargolens.llm.tokens import default_tokenizer


def test_limits_match_the_lengths(documents):
    rows = [(i, prose(i, 1 + i * 13 % 400)) for i in range(80)] + [(i, prose(1, 30)) for i in range(100, 130)]
    rows += [(200, None), (201, ""), (202, "a b " * 3000), (203, "x"), (203, "x")]
    plain = Tokenizer.from_file(default_tokenizer())
    n = np.array([len(plain.encode(t or "", add_special_tokens=False).ids) for _, t in rows])
    lengths = tokencounts.encoded_lengths(documents(rows, extra=[("length", "x")]), keep=["doc_id"])
    assert dict((r.doc_id, r.length) for r in lengths.collect()) == {i: int(k) for (i, _), k in zip(rows, n)}
    limits = tokencounts.context_limits(tokencounts.histogram(lengths)).cache()
    got = {r.length: r for r in limits.collect()}
    assert sorted(got) == sorted(set(n.tolist()))
    for at, r in got.items():
        assert (r.n_docs, r.n_tokens) == ((n == at).sum(), n[n == at].sum())
        assert (r.docs_above, r.tokens_above) == ((n > at).sum(), n[n > at].sum())
        assert (r.total_docs, r.total_tokens, r.truncated_tokens) == (len(n), n.sum(), np.minimum(n, at).sum())
        assert r.share_fitting == (n <= at).mean()
    for limit in (0, 7, 333, 10**6):
        r = tokencounts.at_limit(limits, limit).first()
        assert (r.docs_above, r.truncated_tokens) == ((n > limit).sum(), np.minimum(n, limit).sum())
    for q in (0.1, 0.5, 0.99, 1.0):
        assert tokencounts.quantile(limits, q).first().length == np.sort(n)[int(np.ceil(q * len(n))) - 1]


def test_by_group_and_empty(documents):
    df = documents([(1, "a b c", "p"), (2, "a", "q"), (3, "a b", None), (4, "c d e f g", "p")])
    by = ["source"]
    limits = tokencounts.context_limits(tokencounts.histogram(tokencounts.encoded_lengths(df, keep=by), by), by)
    rows = {(r.source, r.length): (r.docs_above, r.total_tokens) for r in limits.collect()}
    assert rows == {("p", 3): (1, 8), ("p", 5): (0, 8), ("q", 1): (0, 1), (None, 2): (0, 2)}
    empty = tokencounts.context_limits(tokencounts.histogram(tokencounts.encoded_lengths(documents([]))))
    assert empty.count() == 0 and tokencounts.at_limit(empty, 5).first().docs_above == 0
