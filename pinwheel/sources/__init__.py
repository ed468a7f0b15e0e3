from pinwheel.sources.tables import load, transaction_lines, transactions
from pinwheel.sources.text import (parse_points, parse_transactions, read_lines, read_points,
                                   read_transactions)

__all__ = ["load", "transaction_lines", "transactions", "parse_points", "parse_transactions",
           "read_lines", "read_points", "read_transactions"]
