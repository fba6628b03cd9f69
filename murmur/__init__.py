"""murmur: public-opinion analytics as Spark DataFrame transformations.

Column -> Column helpers live in ``functions``, DataFrame -> DataFrame operators
in ``operators``, readers and writers in ``sources``, whole batch jobs in
``plans`` and Structured Streaming jobs in ``streaming``.
"""
