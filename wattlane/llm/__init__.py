"""Operators for preparing training data: each module holds one operator, ``queries`` the registered queries."""
