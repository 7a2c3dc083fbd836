"""Where a run keeps its outputs."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Store:
    """Every path is under one root that all executors can reach.

    With a ``database``, the transactions and marts are tables of it in the catalog, whose dates are replaced in
    one step (``sinks.dated``); without, they are folders by date, and a date is emptied and written again.
    """

    root: str
    database: str | None = None

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejected"

    @property
    def transactions(self) -> str:
        return f"{self.root}/credit_card_transactions"

    @property
    def daily(self) -> str:
        return f"{self.root}/fraud_summary"

    @property
    def hourly(self) -> str:
        return f"{self.root}/hourly_fraud_stats"

    @property
    def summary_statistics(self) -> str:
        return f"{self.root}/summary_statistics"

    @property
    def fraud_by_hour(self) -> str:
        return f"{self.root}/fraud_by_hour"

    @property
    def csv_copy(self) -> str:
        return f"{self.root}/credit_card_transactions_csv"

    @property
    def hour_totals(self) -> str:
        return f"{self.root}/hour_totals"

    @property
    def journal(self) -> str:
        return f"{self.root}/run_journal"

    def table(self, path: str) -> str:
        """The name in the catalog of the table at one of the paths above."""
        return f"`{self.database}`.`{path.rsplit('/', 1)[-1]}`"
