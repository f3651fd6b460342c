import math
from collections import Counter

import pytest
from conftest import canonical

from corpusmill.llm import lm_score


def brute(rows, targets, order):
    seqs = [["<"] * (order - 1) + (t or "").lower().split() + [">"] for _, t in rows]
    marked = [d in targets and d is not None for d, _ in rows]

    def grams(seq):
        c = Counter()
        for i in range(order - 1, len(seq)):
            for n in range(1, order + 1):
                c[("gram", n, tuple(seq[i - n + 1 : i + 1]))] += 1
                c[("of", n, tuple(seq[i - n + 1 : i]))] += 1
        return c

    own = [grams(s) for s in seqs]
    total = [Counter(), Counter()]
    for c, m in zip(own, marked):
        total[0 if m else 1].update(c)
    size = [sum(v for k, v in c.items() if k[0] == "gram" and k[1] == 1) for c in total]
    scale = [min(1, size[1] / size[0]) if size[0] else 1, min(1, size[0] / size[1]) if size[1] else 1]
    vocabulary = len({k[2] for c in total for k in c if k[0] == "gram" and k[1] == 1})
    out = []
    for (d, _), s, c, m in zip(rows, seqs, own, marked):
        losses = []
        for k in (0, 1):
            model = Counter(total[k])
            if m == (k == 0):
                model.subtract(c)
            loss = 0
            for i in range(order - 1, len(s)):
                p = 1 / vocabulary
                for n in range(1, order + 1):
                    prior = lm_score.UNIGRAM_PRIOR * vocabulary if n == 1 else lm_score.CONTEXT_PRIOR
                    p = (scale[k] * model[("gram", n, tuple(s[i - n + 1 : i + 1]))] + prior * p) / (scale[k] * model[("of", n, tuple(s[i - n + 1 : i]))] + prior)
                loss -= math.log(p)
            losses.append(loss / (len(s) - order + 1))
        out.append((d, len(s) - order + 1, *losses))
    return out


ROWS = [(0, "the cat sat on the mat"), (1, "the dog sat"), (2, None), (3, ""), (4, "A cat  a CAT\n the mat"), (5, "dog " * 400), (None, "the cat"), (7, "the dog sat"), (7, "on the mat")]


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("targets", [[0, 4, 7, 7, None, 99], [], [0, 1, 2, 3, 4, 5, 7]])
def test_brute_force(spark, order, targets):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string").repartition(3)
    ids = spark.createDataFrame([(t,) for t in targets], "doc_id bigint")
    got = lm_score.cross_entropy_difference(docs, ids, order, block_bytes=200).collect()
    rounded = lambda rows: sorted(((d, n, round(a, 7), round(b, 7)) for d, n, a, b in rows), key=repr)
    assert rounded((r["doc_id"], r["n_tokens"], r["target_loss"], r["background_loss"]) for r in got) == rounded(brute(ROWS, set(targets), order))
    assert all(r["score"] == pytest.approx(r["target_loss"] - r["background_loss"]) for r in got)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert lm_score.cross_entropy_difference(docs, docs.select("doc_id")).count() == 0


def test_sql(spark, duck, small):
    assert canonical(lm_score.op2_lm_score(spark, small).toPandas()) == canonical(duck.execute(lm_score.OP2_SQL).df())
