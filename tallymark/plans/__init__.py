"""Queries over the driver tables, each with the SQL it must agree with."""

from tallymark.plans.registry import ORACLES, QUERIES  # noqa: F401
from tallymark.plans import rental_reports  # noqa: F401, E402
from tallymark.plans import sales_reports  # noqa: F401, E402
from tallymark.plans import account_reports  # noqa: F401, E402
from tallymark.plans import files_and_columns  # noqa: F401, E402
from tallymark.plans import joins_and_aggregates  # noqa: F401, E402
from tallymark.plans import windows_and_sets  # noqa: F401, E402
from tallymark.plans import scalars  # noqa: F401, E402
from tallymark.plans import tables_and_checks  # noqa: F401, E402
from tallymark.plans import text_and_streams  # noqa: F401, E402
