"""tillwork: retail customer, product and sales analytics as composable PySpark operators.

``functions`` hold Column -> Column expressions, ``operators`` DataFrame -> DataFrame steps,
``sources`` readers and writers, ``streaming`` the message feed, and ``plans`` the end-to-end jobs.
Nothing in the package starts a session, collects rows to the driver, or uses a Python UDF.
"""
