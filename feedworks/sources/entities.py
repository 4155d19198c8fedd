"""The entities that feeds deliver, and their curated tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class CanonicalEntity:
    """Columns of a curated table, and its keys as {key column: id column}.

    The first key identifies a row; the others point at other entities' rows.
    """

    name: str
    ddl: str
    keys: Mapping[str, str]

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def row_id(self) -> str:
        """The id without which rows of one client could not be told apart."""
        return next(iter(self.keys.values()))


# The canonical columns, their order and types.
CUSTOMERS = CanonicalEntity(
    "customers",
    """client_id string, source_customer_id string, first_name string, last_name string,
    email string, phone string, country string, address string, postal_code string,
    signup_date date, status string, age int, loyalty_points int, is_vip boolean,
    marketing_opt_in boolean, _source_file string, _silver_refined_ts timestamp""",
    {"customer_key": "source_customer_id"},
)
TRANSACTIONS = CanonicalEntity(
    "transactions",
    """client_id string, source_transaction_id string, source_customer_id string,
    transaction_ts timestamp, amount decimal(12,2), currency string, channel string,
    payment_type string, quantity int, discount_code string, is_refund boolean,
    tax decimal(12,2), notes string, _source_file string, _silver_refined_ts timestamp""",
    {"transaction_key": "source_transaction_id", "customer_key": "source_customer_id"},
)

#: By name, in the order in which feeds are handled.
CANONICAL: dict[str, CanonicalEntity] = {entity.name: entity for entity in (CUSTOMERS, TRANSACTIONS)}


def register_entity(entity: CanonicalEntity) -> None:
    """Let configs have a section of this name, curated as ``entity`` says.

    Registering a name again replaces it, for instance with more columns.
    """
    CANONICAL[entity.name] = entity
