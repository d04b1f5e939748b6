import os

from lodestat.llm import decontaminate, exact_dedup, jaccard_join
from lodestat.session import Kept, shared_folder


def left_by(spark, stage):
    """The ids that a stage keeps, and the tables that it leaves, by label."""
    folder, made = shared_folder(spark).removeprefix("file:"), ("radix-", "jaccard-", "links", "winnow-")

    def tables():
        return {name for name in os.listdir(folder) if name.startswith(made)}

    before = tables()
    with Kept():
        ids = sorted(r.doc_id for r in stage().collect())
        left = {name.rsplit("-", 1)[0] for name in tables() - before}
    assert tables() == before
    return ids, left


def test_stages_leave_what_their_results_read(spark):
    """Tables made on the way to a decision go once it is stored."""
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text), (2, text.replace(" ", "  ")), (3, text + " more"), (4, "one two three"), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    items = spark.createDataFrame([("a", "one two three")], "item_id string, text string")
    assert left_by(spark, lambda: exact_dedup.drop_exact_copies(docs)) == ([2, 3, 4, 5], {"radix-rows", "radix-kept"})
    near = left_by(spark, lambda: jaccard_join.drop_near_copies(docs, words=5, percent=80))
    assert near == ([1, 4, 5], {"jaccard-rows", "jaccard-kept"})
    assert left_by(spark, lambda: decontaminate.drop_contaminated(docs, items)) == ([1, 2, 3, 5], {"winnow-drop"})
