"""A task keeps one Python worker busy: two at once leave twice as many alive, each with its tables."""

from brute import documents, prose
from newstape.llm import components, decontam, simhash


def at_once(df):
    """Python operators that one task runs at the same time, most of any stage; a sort ends those before it."""
    def down(node):
        children = node.children()
        below = [down(children.apply(k)) for k in range(children.size())]
        name = node.nodeName()
        most = max([m for m, _ in below], default=0)
        open_ = sum(o for _, o in below)
        if "Exchange" in name or name == "Sort":
            open_ = 0
        open_ += name in ("MapInArrow", "PythonMapInArrow")
        return max(most, open_), open_

    plan = df._jdf.queryExecution().executedPlan()
    return down(plan.initialPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan)[0]


def test_links_of_fingerprints_are_found_before_they_shrink(spark, monkeypatch):
    staged = []

    def watched(df, name):
        staged.append((name, at_once(df)))
        return before(df, name)

    before = components.stage
    monkeypatch.setattr(components, "stage", watched)
    docs = documents(spark, [(i, prose(i % 5, 60)) for i in range(20)])
    assert {r.component_id for r in simhash.near_duplicates(docs).collect()} == {0, 1, 2, 3, 4}
    assert staged and max(n for _, n in staged) == 1


def test_hits_are_found_before_they_are_verified(spark):
    docs = documents(spark, [(i, prose(i, 60)) for i in range(5)])
    items = spark.createDataFrame([(7, prose(3, 60))], "item_id long, text string")
    found = decontam.contaminated(docs, items)
    assert at_once(found) == 1
    assert [(r._id, r.item_id) for r in found.collect()] == [(3, 7)]
