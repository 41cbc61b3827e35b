import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """A documents table from (doc_id, text) pairs; extra columns carry the names the operators use themselves."""

    def make(rows, **extra):
        full = [(i, t, "en", "src0", None if t is None else len(t), *extra.values()) for i, t in rows]
        more = "".join(f", {name} string" for name in extra)
        return spark.createDataFrame(full, DOCS + more)

    return make


CLASHES = dict.fromkeys(
    ["fp", "rep", "component_id", "class", "key", "label", "score", "tail", "slice", "place", "blob", "held_out", "h", "item_id", "_key", "bucket"], "x"
)


def words(seed, n, spread=400):
    """n invented words, the same for the same seed."""
    out, state = [], seed * 2654435761 % 2**32 or 1
    for _ in range(n):
        state = (state * 1103515245 + 12345) % 2**31
        out.append("w" + "abcdefghij"[state // 7 % 10] + str(state // 65536 % spread))
    return out


def text(seed, n, spread=400):
    return " ".join(words(seed, n, spread))


EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (None, "no id"), (5, "tie"), (6, "tie"), (7, text(3, 30_000))]
