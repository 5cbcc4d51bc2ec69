"""Helpers to build tiny literal planning inputs for unit tests."""

import datetime as dt
from decimal import Decimal

from planmart.sources import adapters, schemas
from planmart.sources.adapters import Inputs


def D(s):
    return dt.date.fromisoformat(s)


def M(x):
    return None if x is None else Decimal(str(x))


def rev_row(acct, month, rtype, cat, amount):
    return (acct, D(month), rtype, "O", cat, "1-URGENT", M(amount))


def opp_row(acct, date, product, oid, status, usage, stage="1-URGENT", ostatus="O"):
    return (acct, D(date), product, oid, f"Opportunity {oid}", status, ostatus, stage, usage)


def make_inputs(spark, revenue=(), opportunities=(), targets=(), accounts=(), sellers=(),
                prev=None):
    def df(rows, schema):
        return spark.createDataFrame(list(rows), schema)
    return Inputs(
        revenue=df(revenue, schemas.REVENUE),
        opportunities=df(opportunities, schemas.OPPORTUNITIES),
        targets=df(targets, schemas.TARGETS),
        calendar=adapters.calendar(spark),
        accounts=df(accounts, schemas.ACCOUNTS),
        sellers=df(sellers, schemas.SELLERS),
        opportunities_prev=None if prev is None else df(prev, schemas.OPPORTUNITIES),
    )
