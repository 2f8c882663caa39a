"""Spark SQL expressions shared by the operators: text, dates, money and business rules.

Each function takes column names (or expressions) and returns expression text for
`selectExpr` / `F.expr`. Text keeps a wide projection to one call into the JVM per
column, where chained Column operators make one per operator.
"""
