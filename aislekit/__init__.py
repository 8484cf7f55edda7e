"""aislekit: retail data operators expressed as Spark DataFrame plans.

Every operator is a plain function from DataFrames (and parameters) to a
DataFrame, built from Spark's own column expressions so that Catalyst
optimises it and whole-stage codegen runs it.  Nothing is collected to the
driver; the driver only wires plans together.
"""

__version__ = "0.1.0"
