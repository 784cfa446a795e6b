"""Training-data operators: ten corpus jobs and the pipeline that chains them.

Nothing else in the library imports this subpackage.
"""
