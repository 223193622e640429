import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Columns that clash with names the operators use inside or return.
CLASHING = {
    "kept": "'x'", "n_words": "1", "row": "2", "text2": "'t'", "w": "3", "h": "4", "id": "5", "key": "'k'", "size": "6", "score": "0.5",
    "taken": "7", "spans": "'s'", "rules": "8", "k1": "9", "component": "10", "range": "'r'", "copy": "11", "length": "12",
}


@pytest.fixture(scope="session")
def docs(spark):
    """Rows (id, text, source) -> a documents table, with clashing columns on request."""

    def make(rows, clash=False):
        full = [(i, t, "en", s, len(t) if t is not None else None) for i, t, s in rows]
        d = spark.createDataFrame(full, DOCS)
        for name, value in CLASHING.items() if clash else ():
            d = d.selectExpr("*", f"{value} AS `{name}`")
        return d

    return make
