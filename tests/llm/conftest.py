import zlib

import numpy as np
import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Null ids and texts, empty, blank and very long texts, repeated rows."""
    long_text = "lorem ipsum dolor sit amet, " * 20_000
    rows = [(0, "", "en", "a"), (1, None, "en", "a"), (2, " \n\t ", None, None), (3, "one", "en", None),
            (4, long_text, "en", "a"), (5, long_text, "de", "a"), (None, "no id here", "en", "a"),
            (6, "same same same", "en", "a"), (6, "same same same", "en", "a"), (7, "x" * 50_000, "en", "b"),
            (8, "a b c d e f g h i j k l m n o p", "en", "b"), (9, "A B C D E f g h i j k l m n o p", "en", "b")]
    return spark.createDataFrame([(i, t, la, s, len(t or "")) for i, t, la, s in rows], DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4"))


def rows_of(df):
    return [r.asDict() for r in df.collect()]

