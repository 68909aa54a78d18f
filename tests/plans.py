"""What the executed plan of a DataFrame did."""


def operators(frame):
    """The executed physical operators, from the top."""

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            yield from walk(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            yield from walk(node.plan())
        else:
            yield node
            children = node.children().iterator()
            while children.hasNext():
                yield from walk(children.next())

    return list(walk(frame._jdf.queryExecution().executedPlan()))


def final_plan(frame):
    """Text of the plan after adaptive changes; the frame must have been executed."""
    return frame._jdf.queryExecution().executedPlan().toString()


def scanned_rows(frame):
    """Rows each file scan of the executed frame returned."""
    scans = [n for n in operators(frame) if n.nodeName().startswith("Scan parquet")]
    return [n.metrics().apply("numOutputRows").value() for n in scans]
