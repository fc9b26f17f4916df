"""Order, warehouse and property-tax analytics written as Spark jobs.

Every function takes DataFrames and returns DataFrames; nothing is updated in place.
"""
