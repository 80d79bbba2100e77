from pyspark.sql import functions as F

from tidemark.operators.attribution import REG_SIDE, attribute, attribute_best
from conftest import rows

LC = "organiser_Id long, email string, prospect_id string, recordType string, SF_Id string"
OUT = ["prospect_id", "SF_Id", "communities_id", "matched_registrations"]


def inputs(spark):
    lc = spark.createDataFrame([(1, "a@x", "p1", "LEAD", "L1"), (1, "a@x", "p2", "CONTACT", "C1"), (1, "b@x", "p3", "LEAD", "L2"),
                                (1, None, "p4", "LEAD", "L3"), (2, "a@x", "p5", "LEAD", "L4")], LC)
    reg = spark.createDataFrame([(1, "a@x", "r1", 10.0), (1, "a@x", "r2", 30.0), (1, "a@x", "r3", 20.0), (2, "a@x", "r4", 10.0), (1, None, "r5", 10.0),
                                 (1, "c@x", "r6", 10.0)], "organiser_Id long, email string, communities_id string, localCreatedAt double")
    have = set(reg.columns)
    return lc, reg.select("*", *(F.lit(None).cast("string").alias(c) for c in REG_SIDE if c not in have))


def test_every_registration_of_a_person_is_paired(spark):
    assert rows(attribute(*inputs(spark)), *OUT) == [
        ("p1", "L1", "r1", 3), ("p1", "L1", "r2", 3), ("p1", "L1", "r3", 3), ("p2", "C1", "r1", 3), ("p2", "C1", "r2", 3), ("p2", "C1", "r3", 3),
        ("p3", "L2", None, 0), ("p4", "L3", None, 0), ("p5", "L4", "r4", 1)]


def test_best_registration_is_one_of_the_pairs(spark):
    lc, reg = inputs(spark)
    best = rows(attribute_best(lc, reg), *OUT)
    assert best == [("p1", "L1", "r2", 3), ("p2", "C1", "r2", 3), ("p3", "L2", None, 0), ("p4", "L3", None, 0), ("p5", "L4", "r4", 1)]
    assert set(best) <= set(rows(attribute(lc, reg), *OUT))
