"""Sample visits, and an independent way to work out what they must give."""

import csv
import datetime as dt
import io
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

VISIT_DDL = (
    "patient_id int, name string, age int, diagnosis string, visit_date date, "
    "billing_amount double"
)
LOADED_DDL = VISIT_DDL + ", ingestion_timestamp string"
HEADER = "patient_id,name,age,diagnosis,visit_date,billing_amount\n"


def day(n):
    return dt.date(2023, 6, n)


# First load: an age and an amount are missing, one age is the least that is valid.
OPENING = HEADER + """902,Ines,,Sprain,2023-06-12,48.75
315,Karl,64,Fracture,2023-06-11,1290.4
488,Lea,7,Sprain,2023-06-13,
127,Milo,39,Burn,2023-06-11,66.05
760,Nils,0,Fracture,2023-06-13,310.0
"""
# With a second load: the greatest valid age, a patient who comes back for something else, and
# a visit without a diagnosis.
SEQUEL = OPENING + """551,Olga,150,Burn,2023-06-15,9.95
127,Milo,40,Fracture,2023-06-14,480.5
833,Pavel,22,,2023-06-16,75.0
"""
WITH_DOCTOR = """patient_id,name,age,diagnosis,visit_date,billing_amount,doctor_id
551,Olga,150,Burn,2023-06-15,9.95,house-3
"""
# No number for an age, a day that does not exist, and no number for an amount.
CORRUPT = HEADER + """610,Sam,fifty,Burn,2023-06-12,20.0
611,Tia,31,Burn,2023-06-31,15.5
612,Uwe,44,Sprain,2023-06-12,12.25
613,Val,,Burn,2023-06-12,lots
"""
#: One rule each: what the cleaning and the choice of the latest visit do with a row.
PROBES = [
    # both bounds of the age are valid, and one step beyond is not
    "14,Ute,150,burn,2023-06-11,1.5,2023-06-20 08:00:00",
    "15, Vic ,0, Sprain ,2023-06-12,0.0,2023-06-20 08:00:00",
    "16,Wes,151,burn,2023-06-12,5.0,2023-06-20 08:00:00",
    "17,Xia,-1,burn,2023-06-12,5.0,2023-06-20 08:00:00",
    # an amount just below zero, and a row that breaks two rules
    "18,Yan,30,burn,2023-06-13,-0.01,2023-06-20 08:00:00",
    "22,Dov,200,burn,2023-06-15,-4,2023-06-20 08:00:00",
    # what is missing is filled; a tab is not a blank; NaN is missing
    "19,Zoe,,,2023-06-13,,2023-06-20 08:00:00",
    "20,,44,\t,2023-06-14,NaN,2023-06-20 08:00:00",
    # the same visit in a later load
    "14,Ute,150,burn,2023-06-11,1.5,2023-06-21 08:00:00",
    # without an id there is one patient, whose latest visit stays
    ",Bea,21,sprain,2023-06-15,8.0,2023-06-20 08:00:00",
    ",Ann,20,sprain,2023-06-14,7.0,2023-06-20 08:00:00",
    # a date beats none, and a visit without one may be all there is
    "21,Cid,50,sprain,,9.0,2023-06-22 08:00:00",
    "21,Cid,50,sprain,2023-06-10,9.5,2023-06-20 08:00:00",
    "23,Eli,1,burn,,1.0,2023-06-20 08:00:00",
]
BRONZE = HEADER.strip() + ",ingestion_timestamp\n" + "\n".join(PROBES) + "\n"
REJECTED = {
    16: ["age_out_of_range"],
    17: ["age_out_of_range"],
    18: ["negative_billing"],
    22: ["age_out_of_range", "negative_billing"],
}
SILVER = HEADER + """44,I,61,FRACTURE,2023-06-12,500.0
40,E,12,BURN,2023-06-19,10.25
42,G,90,SPRAIN,2023-06-15,30.75
41,F,13,BURN,2023-06-11,20.5
46,K,63,BURN,2023-06-16,0.35
45,J,62,SPRAIN,2023-06-13,100.1
43,H,0,SPRAIN,2023-06-14,0.0
"""


def month_of_visits():
    """A visit file by rule: 28 days, patients of whom some come back, seven diagnoses."""
    lines = [
        f"{k * 37 % 29},p{k},{k * 11 % 97},code {k % 7},2023-06-{1 + k * 5 % 28:02d},{k * k % 1009 / 8}"
        for k in range(75)
    ]
    return HEADER + "\n".join(lines) + "\n"


def rounded(value, places):
    return float(value.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP))


def gold_of(text, after=None):
    """Gold rows of visits without rejects, by rank, in plain Python; the latest date wins."""
    latest, groups = {}, {}
    for r in csv.DictReader(io.StringIO(text)):
        date = dt.date.fromisoformat(r["visit_date"])
        if after is None or date > after:
            amount, age = Decimal(r["billing_amount"] or 0), int(r["age"] or 0)
            group = r["diagnosis"].upper() or "UNKNOWN"
            if r["patient_id"] not in latest or date > latest[r["patient_id"]][0]:
                latest[r["patient_id"]] = (date, group, amount, age)
    for date, group, amount, age in latest.values():
        groups.setdefault(group, []).append((amount, age, date))
    rows = []
    for name, visits in groups.items():
        amounts, ages, dates = zip(*visits, strict=True)
        total, n = sum(amounts), len(visits)
        rows.append(
            (
                name,
                float(total),
                rounded(total / n, 2),
                n,
                min(ages),
                max(ages),
                rounded(Decimal(sum(ages)) / n, 1),
                min(dates),
                max(dates),
                1 + sum(sum(x[0] for x in other) > total for other in groups.values()),
            )
        )
    return sorted(rows, key=lambda r: r[-1])


def insights_of(text, after=None):
    """Top group, its billing, revenue and patients per group, in plain Python."""
    gold = gold_of(text, after)
    return {
        "top_diagnosis": gold[0][0],
        "top_billing": gold[0][1],
        "total_revenue": float(sum(Decimal(repr(r[1])) for r in gold)),
        "patient_distribution": {r[0]: r[3] for r in gold},
    }


def frame(spark, text, ddl):
    """The rows of headered delimited text."""
    lines = [(line,) for line in text.splitlines()[1:]]
    parsed = F.from_csv("line", ddl).alias("row")
    return spark.createDataFrame(lines, "line string").select(parsed).select("row.*")
