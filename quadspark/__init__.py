"""Build, describe and query RDF datasets with Spark DataFrames.

Graphs are DataFrames of triples or quads with flat term columns (see
``functions.terms``); solutions are DataFrames with one column per variable.
Every operator is a function from DataFrames to a DataFrame.
"""
