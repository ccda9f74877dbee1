"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it. Each module holds one operator;
``registry`` holds the thin queries ``opN_<name>`` and their DuckDB SQL.
"""
