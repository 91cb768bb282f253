from tramlake.program import main

for thread in main():
    thread.join()
