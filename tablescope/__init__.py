"""tablescope: Spark table operators for taking an unknown dataset to results.

Every operator takes DataFrames and returns DataFrames; nothing row-sized
passes through the driver.
"""
