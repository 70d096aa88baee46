"""A PySpark-native engine for collections of public communications.

``functions`` holds column expressions, ``operators`` relational operators,
``sources`` readers and writers, ``streaming`` the incremental twins and
``plans`` the named queries with the SQL they are checked against.
"""
