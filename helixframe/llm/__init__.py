"""Training-data pipeline operators: filters, classifiers, joins, packing, binary output, fixity.

Each module holds one operator with a general interface; ``queries`` registers the
thin queries over the given tables. Nothing outside this folder imports it.
"""
