"""Vernissage: a Spark-native engine for crawled market data.

The core (``functions``, ``operators``, ``sources``, ``streaming``, ``plans``)
never imports ``vernissage.llm``; that subpackage may be removed.
"""

__version__ = "0.1.0"
