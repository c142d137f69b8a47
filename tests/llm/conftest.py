import zlib

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """DataFrame of documents from (doc_id, text) or (doc_id, text, lang, source)."""

    def make(*rows):
        full = [(r + ("en", "s"))[:4] + (len(r[1] or ""),) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


def crc(values):
    return zlib.crc32(b"".join(v.to_bytes(4, "little") for v in values))
