"""berthline — shipment feature engineering as Spark DataFrame operators.

Operators are ``DataFrame -> DataFrame`` functions meant for ``df.transform``;
fit/transform encoders return small fitted DataFrames that are joined back.
"""

__version__ = "0.1.0"
