"""Training-data preparation: thirteen operators over ``documents`` and ``conversations``.

One module per operator; ``queries`` registers the production queries.
Nothing else in the library imports this package.
"""
