"""What the tests read from physical plans."""


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    """The plan in the form that does not shorten lists."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def scan_rows(df):
    """Output rows of the file scans of an executed plan, subqueries included."""
    found = []

    def walk(node):
        if "AdaptiveSparkPlanExec" in node.getClass().getName():
            walk(node.executedPlan())
        if "QueryStageExec" in node.getClass().getName():
            walk(node.plan())
        metrics = node.metrics()
        if "FileSourceScan" in node.getClass().getName():
            found.append(metrics.get("numOutputRows").get().value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found
