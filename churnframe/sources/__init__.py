from churnframe.sources.fixtures import prediction_log, subscriber, subscriber_raw  # noqa: F401
from churnframe.sources.raw import read_raw, require_columns  # noqa: F401
from churnframe.sources.tables import TABLES, read_table  # noqa: F401
