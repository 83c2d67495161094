"""The five-person sample graph, built with MERGE so running it again changes nothing.

It is fixed input, so it backs tests and examples, not a registered query.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from trellis.model import Graph
from trellis.operators.merge import merge_nodes, merge_rels

# Fixed values (they must equal the reference's sample graph).
PEOPLE = [
    ("Alice", 30, "New York"),
    ("Bob", 25, "San Francisco"),
    ("Carol", 35, "Seattle"),
    ("David", 28, "Boston"),
    ("Eve", 32, "Chicago"),
]
KNOWS = [
    ("Alice", "Bob", 2020),
    ("Bob", "Carol", 2019),
    ("Alice", "David", 2021),
    ("David", "Eve", 2022),
    ("Carol", "Eve", 2018),
]


def sample_graph(spark: SparkSession, graph: Graph | None = None) -> Graph:
    """MERGE (:Person {name, age, city}) x5, then MATCH .. MERGE (a)-[:KNOWS {since}]->(b) x5.
    Inline MERGE properties are the key; the node id is the name."""
    g = graph or Graph()
    people = spark.createDataFrame(PEOPLE, "name string, age int, city string")
    if "Person" not in g.nodes:
        g = g.with_nodes("Person", people.where(F.lit(False)), "name")
    g, _ = merge_nodes(g, "Person", people, {"name": F.col("name")},
                       on_create={"age": F.col("age"), "city": F.col("city")})
    knows = spark.createDataFrame(KNOWS, "a string, b string, since int")
    g, _ = merge_rels(g, "KNOWS", "Person", "Person", knows, {"name": "a"}, {"name": "b"},
                      key_props={"since": F.col("since")})
    return g
