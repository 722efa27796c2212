from dataclasses import replace

from pyspark.sql import functions as F

from tessella.operators.filters import first_failed_check
from tessella.plans.options import DOCUMENT_CHECKS

CHECKS = replace(
    DOCUMENT_CHECKS.without_models(), min_words=1, max_words=None, max_char_repetition=None, max_word_repetition=None,
    max_special_chars=None, min_stop_words=0.5, stop_words=("من", "on"), max_flagged_words=None, min_punctuation=None, min_common_words=None,
)


def test_words_are_searched_again_only_with_diacritics(spark):
    texts = spark.createDataFrame([("on a",), ("a b c",), ("مِنْ a",)], "text string")
    judged = texts.select("text", first_failed_check(F.col("text"), CHECKS).alias("failed"))
    assert {r["text"]: r["failed"] for r in judged.collect()} == {"on a": None, "a b c": "stop_words", "مِنْ a": None}
    assert "RLIKE" in judged._jdf.queryExecution().optimizedPlan().toString()
