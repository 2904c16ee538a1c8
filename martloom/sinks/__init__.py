"""Where results go: mart tables and message topics."""
