from decimal import Decimal

from tidemark.operators.funnel import attendance_metrics, event_funnel
from conftest import rows

C = ("SF_Id string, organiser_Id long, event_id long, opportunity_Id string, initLoginAt long, IsClosed boolean, "
     "IsWon boolean, touch_point int, opportunity_Amount double, recordType string")
R = "organiser_Id long, event_id long, userId string, initLoginAt long"


def test_funnel_modes_and_double_counted_registrations(spark):
    contacts = spark.createDataFrame([
        ("L1", 1, 5, "O1", None, True, True, 2, 10.5, "LEAD"),
        ("C1", 1, 5, "O2", None, True, False, 0, 4.25, "CONTACT"),
        ("L2", 1, None, "O3", None, False, False, 0, 1.0, "LEAD"),
    ], C)
    regs = spark.createDataFrame([(1, 5, "u1", None), (1, 5, "u1", 77), (1, 6, "u2", 1)], R)
    keep = rows(event_funnel(contacts, regs, 9).drop("load_timestamp"))
    assert (1, 5, 2, 1, Decimal("14.750000"), Decimal("10.500000"), 1, 2, 1) in keep
    assert (1, None, 1, 0, Decimal("1.000000"), Decimal("0E-6"), 1, 0, 0) in keep
    legacy = rows(event_funnel(contacts, regs, 9, unattributed="zero_row").drop("load_timestamp"))
    assert (1, 0, 0, 0, Decimal("0E-6"), Decimal("0E-6"), 0, 0, 0) in legacy
    assert len(legacy) == 2          # attendance-only event 6 is not in the spine


def test_attendance_ignores_null_users(spark):
    regs = spark.createDataFrame([(1, 5, None, None), (1, 5, "u", None)], R)
    assert rows(attendance_metrics(regs)) == [(1, 5, 1, 0)]
