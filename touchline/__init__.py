"""touchline: customer analytics and propensity modelling as Spark jobs.

DataFrame in, DataFrame out. The sub-packages are:

* ``sources``    reading and writing tables, files, models
* ``functions``  column expressions
* ``operators``  joins, roll-ups, sessions, features, models, metrics, audiences
* ``plans``      the workflow steps put together (silver, gold, train, score)
* ``streaming``  the same steps over streams
"""

__version__ = "0.1.0"
