"""The bounded samples of labelled documents."""

import random

import pytest

from pricelens.llm import compress_quality, toxicity


@pytest.mark.parametrize("module, label", [(compress_quality, "quality"), (toxicity, "toxic")])
def test_rows_of_one_labelled_doc_id_count_once(spark, module, label):
    rnd = random.Random(4)
    texts = [(i, " ".join(rnd.choice(["vile", "scum", "ahem"] if i % 2 else ["good", "kind", "ahem"]) + f" w{rnd.randrange(500)}"
                          for _ in range(40))) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], f"doc_id long, {label} int")
    once = module.fit(spark.createDataFrame(texts, "doc_id long, text string"), labels)
    again = texts + [(i, t + " zz") for i in (2, 3, 4, 6, 7, 8) for t in [texts[i][1]] for _ in range(300)]
    assert "constant" not in once
    more = module.fit(spark.createDataFrame(again, "doc_id long, text string"), labels)
    assert more["logistic"]["beta"] == pytest.approx(once["logistic"]["beta"])
    assert {k: v for k, v in more.items() if k != "logistic"} == {k: v for k, v in once.items() if k != "logistic"}
