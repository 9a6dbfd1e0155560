import os

import pytest

DATA = "/root/testdata/sf0.001"
#: Rows that every operator has to take: null, empty and long texts, repeated rows, clashing extra columns.
ODD = [(1, None), (2, ""), (3, " \n\x0b"), (4, "word " * 20000), (5, "x" * 30000), (6, "same text here"), (6, "same text here"), (7, "same text here"), (None, "no id at all")]


#: Names that operators use themselves, past and present, and awkward ones.
CLASHING = (
    "_before _copy_key _drops _key _lower _mix _mix_at _mix_source _no _pii_clean _pii_key _pii_spans _pii_until _rank _row _s _salt _seen _text _words again at base before clean comp component_id cut"
    " epochs found fp group hashes hits host ids key keys kept label labels least length more n named node p_good page pages pattern piece rank root row salt score secrets spans taken times token tokens"
    " until votes weight words a.b"
).split() + ["two words"]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd documents with extra columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in ODD], "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit(7) for c in CLASHING})


@pytest.fixture(scope="session")
def documents(spark):
    if not os.path.isdir(DATA):
        pytest.skip("no test data")
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}
