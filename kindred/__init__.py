"""Product similarity on Spark: bronze listings to ranked look-alikes."""
