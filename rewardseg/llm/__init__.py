"""Operators of a training-data pipeline.

One module per operator with a general interface, its thin ``opN_<name>`` query and, where SQL can
state the result, its DuckDB SQL.  ``registry`` lists the queries.  Nothing outside this subpackage
imports it.
"""
