import hashlib
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="session")
def documents(spark):
    """``documents(rows)``: rows ``(doc_id, text[, source[, lang]])`` as the driver's table."""

    def make(*rows, partitions=3):
        full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").repartition(partitions)

    return make


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
