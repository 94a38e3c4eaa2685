"""Operators of a training-data pipeline over ``documents`` (doc_id, text, ...).

Every operator takes DataFrames, selects only the columns it needs (so extra or
clashing columns never matter), treats a null text as empty and returns a
DataFrame. ``queries`` registers one thin query per operator.
"""
