"""Query plans: registered queries over the test tables, their oracle SQL,
and the medallion jobs that run the layers end to end."""
