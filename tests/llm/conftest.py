import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "k string, x string, row string, id string, kept string, size string, fp string, key string"
)
EXTRA = ("extra",) * 8


@pytest.fixture
def documents(spark):
    """A table of documents from (id, text) or (id, text, source), with columns whose names clash."""

    def build(rows):
        full = [
            (r[0], r[1], "en" if r[1] else None, r[2] if len(r) > 2 else "s", len(r[1] or ""))
            + EXTRA
            for r in rows
        ]
        return spark.createDataFrame(full, SCHEMA)

    return build


def words(text):
    """Words as the operators see them: runs of anything but space and tab to carriage return."""
    return (text or "").encode().split()


MESSY = [
    (1, "one two three four"),
    (2, None),
    (3, ""),
    (None, "a null id"),
    (5, " \t\n "),
    (6, "one two three four"),
    (6, "one two three four"),
    (8, "é ß ñ 漢字 " * 3),
    (9, "long " + "word more " * 30_000),
    (None, None),
    (11, "\u0000 zero \u0085 next"),
]
