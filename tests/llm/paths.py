from issuewatch.session import scratch_path


def scratch(spark, name):
    return scratch_path(spark, f"test-{name}")
