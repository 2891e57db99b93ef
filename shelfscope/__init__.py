"""shelfscope: ad and retail report engine on PySpark."""
