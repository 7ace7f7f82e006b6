"""The denormalised modelling table: clients, districts, accounts, loans and transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuadra.operators.columns import drop_nulls, label_in_set
from cuadra.operators.joins import inner_join, left_join, right_join


def mining_table(
    client: DataFrame, district: DataFrame, disp: DataFrame, account: DataFrame, loan: DataFrame, stats: DataFrame
) -> DataFrame:
    """One row per loan and disposition of its account.

    client(client_no, home_no, ...) LEFT district(place_no, ...) INNER disp(holder_no, held_account,
    ...) INNER account(account_no, ...) RIGHT loan(loan_account, ...) LEFT stats(summed_account, ...).

    Every loan is kept, with nulls where its account has no client. Statistics go by the account
    that was matched, so they are null for an unmatched loan even if its account has transactions.

    The joins run in another order with the same rows. Statistics are joined to the account, so
    that the unmatched loans, which share the null key, are not sent to one task. Clients come
    last before the loans: both sides of the loan join are then shuffled for it alone, and adaptive
    execution can split the loans of an account that owns a large part of them.
    """
    known = left_join(account, stats, "account_no", "summed_account")
    held = inner_join(disp, known, "held_account", "account_no")
    people = left_join(client, district, "home_no", "place_no")
    accounts = inner_join(people, held, "client_no", "holder_no")
    joined = right_join(accounts, loan, "account_no", "loan_account")
    order = [*client.columns, *district.columns, *disp.columns, *account.columns, *loan.columns, *stats.columns]
    return joined.select(*order)


def clean_for_model(table: DataFrame, columns: list[str], status: str, good: tuple[str, ...], yes: str, no: str) -> DataFrame:
    """Keep the model columns, drop rows with a missing one, and replace the status by its label."""
    kept = drop_nulls(table.select(*columns, status))
    return kept.withColumn("candidate", label_in_set(F.col(status), good, yes, no)).drop(status)
