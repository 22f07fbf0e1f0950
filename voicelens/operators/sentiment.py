"""SEN-1 lexicon sentiment, SEN-2 learned sentiment.

SEN-1: sum of token polarities, a token right after a negation word counts
with the opposite sign; emo = 2 (positive), 1 (neutral) or 0 (negative).
``operators.lexicon.polarity_scores`` sums them by a join, for a lexicon of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def emo_class(score: Column) -> Column:
    return F.when(score > 0, 2).when(score < 0, 0).otherwise(1).cast("int")


def term_counts(docs: DataFrame, text_col: str = "text", num_features: int = 1 << 18) -> DataFrame:
    """The other columns and ``_tf``: the hashed counts of the text's words (RegexTokenizer + HashingTF)."""
    from pyspark.ml.feature import HashingTF, RegexTokenizer

    tok = RegexTokenizer(inputCol=text_col, outputCol="_tok", pattern="[^a-zà-öø-ÿß]+", toLowercase=True)
    tf = HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features)
    return tf.transform(tok.transform(docs)).drop(text_col, "_tok")


def sentiment_model(train: DataFrame, label_col: str = "label"):
    """SEN-2: IDF + multinomial logistic regression in one ML Pipeline, on the stored ``term_counts`` of labelled texts.

    The fit passes over its rows several times, so texts are not split into words inside it.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF

    idf = IDF(inputCol="_tf", outputCol="_features")
    lr = LogisticRegression(featuresCol="_features", labelCol=label_col, maxIter=20, family="multinomial")
    return Pipeline(stages=[idf, lr]).fit(train)
