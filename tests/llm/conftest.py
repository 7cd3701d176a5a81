import pytest

#: Extra columns whose names the operators use inside.
CLASH = {"doc": "x", "row": "y", "_id": 12, "_row": 13, "_here": 14, "_host": "h", "host": "i", "path": "j", "n": 3, "cls": 4, "token": 5, "hi": 6, "lo": 7, "keep": False, "score": 0.5, "root": 1, "item_id": 9, "hash": 10, "lost": None, "kept_text": "z", "length": 11}


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a documents table: (doc_id, text[, lang, source]) rows, extra columns on demand."""

    def build(rows, clash=False):
        full = [(i, t, *(rest or ("en", "src0")), None if t is None else len(t)) for i, t, *rest in rows]
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
        if clash:
            full = [(*r, *CLASH.values()) for r in full]
            schema += ", doc string, row string, _id int, _row int, _here int, _host string, host string, path string, n int, cls int, token int, hi int, lo int, keep boolean, score double, root int, item_id int, hash int, lost string, kept_text string, length int"
        return spark.createDataFrame(full, schema)

    return build
