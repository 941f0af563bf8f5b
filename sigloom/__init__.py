"""sigloom: profile, generate and validate related tables as Spark DataFrame plans."""
