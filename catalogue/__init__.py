"""One query per operator over the test tables, and the SQL each must agree with."""

from catalogue.oracles import ORACLES
from catalogue.spark_queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
