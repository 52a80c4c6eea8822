"""The training-data pipeline: stages that each apply one operator to what the one before kept."""

from auditlake.llm import stages

STAGES = stages.STAGES
#: SQL can express neither the models nor the components; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The last stage's rows over the whole documents table."""
    return stages.run(spark, sf_dir, STAGES)
