"""All registered queries and their oracles."""

from pyspark.sql import DataFrame, SparkSession

from suite.inputs import Inputs
from suite.more import MORE
from suite.more_oracles import MORE_ORACLES
from suite.oracles import ORACLES as FIRST_ORACLES
from suite.queries import QUERIES as FIRST
from suite.stored import STORED, STORED_ORACLES

QUERIES = FIRST | MORE | STORED
ORACLES = FIRST_ORACLES | MORE_ORACLES | STORED_ORACLES


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES[name](Inputs(spark, sf_dir))
